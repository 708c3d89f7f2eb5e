"""Exact top-k search by inner product in a paged M-tree.

Inner products become distances by one more coordinate: with M the largest
squared norm of the vectors, x' = (x, sqrt(M - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + M - 2 q.x, so the nearest points are those of the highest
product.  The tree has three levels over the entries: routing objects from a
bounded sample with the largest covering radius of their pages, pages with
covering radii of their own, and inside a page nodes with a routing entry, a
covering radius, the distance to the page's routing object, and each entry's
distance to the node's.  A block of queries first searches the pages under the
queries' nearest routing objects, then those that can still reach a query's k-th
best score; pages under all others are not read.  Pages of a batch and the nodes
of a page are visited best first, and the triangle inequality on the stored
distances skips pages, nodes and entries.  Bounds are doubles with a margin for
their rounding errors; scores are exact integers.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.session import materialize, scratch_path

#: Routing objects sampled for the top level, entries of a page and of a node, queries of a block.
ROUTERS, PAGE, NODE, BLOCK = 256, 2048, 64, 4096
SCALE = 1024
#: Largest sum of squared norms for which products and distances of integers are exact in doubles.
EXACT = float(1 << 52)
LONG, DIGITS_38 = (1 << 63) - 1, 10 ** 38 - 1


def scaled_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (vec_id, vec): floor(1024 x) of each component, as bytes of 64-bit integers.

    Rows without an id, and vectors that are null or have a null or non-finite
    component, are left out.  Shorter vectors are filled up with zeros.
    Components beyond a long are given as the nearest long that a double can hold.
    """
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null and v is not null")
    width = rows.agg(F.max(F.size("v")).alias("w")).first()["w"] or 0

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = v.values
                x = x.to_numpy(zero_copy_only=False) if x.null_count == 0 else np.full(1, np.nan)
                if np.isfinite(x).all():
                    full = np.zeros(width, "<i8")
                    with np.errstate(over="ignore"):
                        full[:len(x)] = np.clip(np.floor(x * SCALE), -2.0 ** 63, 2.0 ** 63 - 1024)
                    ids.append(i)
                    vecs.append(full.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())],
                                             names=["vec_id", "vec"])

    return rows.mapInArrow(scaled, "vec_id long, vec binary").distinct()


def distinct_points(vectors: DataFrame, k: int) -> DataFrame:
    """(vec, ids): each distinct vector with its k + 1 smallest ids.

    No result holds more rows of one vector than that: equal scores go to the
    smaller ids, and a query's own row is at most one of them.
    """
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = vectors.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _integers(vecs) -> np.ndarray:
    return np.array([np.frombuffer(v, "<i8") for v in vecs], np.int64)


def _matrix(vecs) -> np.ndarray:
    return _integers(vecs).astype(np.float64)


def _distance(products: np.ndarray, a_norm2, b_norm2, most: float, both: bool) -> np.ndarray:
    """Distances in the lifted space; ``both`` if both sides are points (else a is a query)."""
    square = a_norm2 + b_norm2 - 2 * products
    if both:
        square = square + (np.sqrt(np.maximum(most - a_norm2, 0)) - np.sqrt(np.maximum(most - b_norm2, 0))) ** 2
    else:
        square = square + most - b_norm2
    return np.sqrt(np.maximum(square, 0))


def build_page(vecs: np.ndarray, router: np.ndarray, most: float) -> dict:
    """Nodes of one page: order of the entries, starts, routing entries, radii, distances to parents."""
    n, norm2 = len(vecs), (vecs ** 2).sum(1)
    pivots = np.linspace(0, n - 1, max(1, -(-n // NODE))).astype(int)  # entries come in hash order
    near = _distance(vecs @ vecs[pivots].T, norm2[:, None], norm2[pivots][None], most, True)
    node = near.argmin(1)
    order = np.argsort(node, kind="stable")
    to_router = _distance(vecs @ router, norm2, (router ** 2).sum(), most, True)
    used, starts = np.unique(node[order], return_index=True)
    to_node = near[np.arange(n), node][order]
    to_page = _distance(vecs[pivots[used]] @ router, norm2[pivots[used]], (router ** 2).sum(), most, True)
    return {"order": order, "starts": np.append(starts, n), "routing": vecs[pivots[used]],
            "radius": np.maximum.reduceat(to_node, starts), "to_page": to_page, "to_node": to_node,
            "page_radius": float(to_router.max())}


def with_router(points: DataFrame, top, most: float) -> DataFrame:
    """``points`` (a column vec) with the number of the nearest routing object of the broadcast matrix ``top``."""
    names = points.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema) + ", router int"

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routers = top.value
        top2 = (routers ** 2).sum(1)
        for batch in batches:
            v = _matrix(batch.column(names.index("vec")).to_pylist())
            if len(v):
                near = _distance(v @ routers.T, (v ** 2).sum(1)[:, None], top2[None], most, True).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], names=[*names, "router"])

    return points.mapInArrow(assigned, schema)


class Index:
    """Pages by router in the shared folder; M; the routing objects, their ids and their pages' largest radius."""

    def __init__(self, pages: DataFrame, most: float, routers: np.ndarray, router_ids: list[list[int]], shared):
        self.pages, self.most, self.routers, self.router_ids, self.shared = pages, most, routers, router_ids, shared
        self.radius = np.full(len(routers), -np.inf)  # none: no page
        for row in pages.groupBy("router").agg(F.max("page_radius").alias("r")).collect():
            self.radius[row["router"]] = row["r"]


def build_index(points: DataFrame, k: int) -> Index:
    """The index, one row per page.

    Routing objects are the ``ROUTERS`` distinct vectors of lowest hash (a bounded
    sample); every vector is indexed.  A crowded routing object gets several pages.
    Pages lie in a folder per routing object, so those of others are not read.
    """
    most = float(points.agg(F.max(_norm2("vec"))).first()[0] or 0)
    sample = points.orderBy(F.xxhash64("vec"), "vec").limit(ROUTERS).collect()
    routers, router_ids = _matrix([r["vec"] for r in sample]), [list(r["ids"]) for r in sample]
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast(routers)
    under = materialize(with_router(points, shared, most), "mtree-entries")
    pages = under.groupBy("router").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAGE)).alias("pages"))
    dealt = under.join(F.broadcast(pages), "router").withColumn(
        "page", F.pmod(F.xxhash64("vec"), F.col("pages")).cast("int"))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        router = int(rows["router"].iloc[0])
        whole = _integers(rows["vec"])
        page = build_page(whole.astype(np.float64), shared.value[router], most)
        ids = [rows["ids"].iloc[i] for i in page["order"]]
        return pd.DataFrame([{
            "router": router, "page_radius": page["page_radius"], "vecs": whole[page["order"]].tobytes(), "starts": page["starts"].tolist(),
            "routing": page["routing"].astype("<i8").tobytes(), "radius": page["radius"].tolist(),
            "to_page": page["to_page"].tolist(), "to_node": page["to_node"].tolist(),
            "ids": np.concatenate(ids).tolist(), "many": [len(x) for x in ids]}])

    index = dealt.groupBy("router", "page").applyInPandas(
        build, "router int, page_radius double, vecs binary, starts array<long>, routing binary, radius array<double>, "
               "to_page array<double>, to_node array<double>, ids array<long>, many array<int>")
    path = scratch_path(spark, "mtree-pages")
    index.write.partitionBy("router").parquet(path)
    return Index(spark.read.schema(index.schema).parquet(path), most, routers, router_ids, shared)


def _norm2(col: str) -> F.Column:
    @F.pandas_udf("double")
    def norm2(vecs: pd.Series) -> pd.Series:
        return vecs.map(lambda v: float((np.frombuffer(v, "<i8").astype(float) ** 2).sum()))

    return norm2(col)


class Searcher:
    """The k best of a block of queries over the pages that one task reads."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, most: float, k: int):
        self.ids, self.whole, self.most, self.k = ids, queries, most, k
        self.q = queries.astype(np.float64)
        self.q2 = (self.q ** 2).sum(1)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), sorted
        self.floor = floor.copy()  # no lower score, but for the slack, can be among the k best
        self.ceiling = self.q2 + most
        self.exact = not len(ids) or self.ceiling.max() < EXACT
        #: Error of a square of a distance or of two products, zero where integers are exact.
        self.slack = np.zeros(len(ids)) if self.exact else (queries.shape[1] + 4) * 2.0 ** -51 * self.ceiling
        self.computed = self.pages_skipped = 0

    def reach(self, which: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Highest score possible at a distance (rounding errors allowed for)."""
        near = np.maximum(distance - 4 * np.sqrt(self.slack[which])[:, None], 0)
        ceiling = self.ceiling[which][:, None]
        return (ceiling - near ** 2) / 2 + 1e-9 * ceiling + self.slack[which][:, None] + 0.5

    def to_routers(self, routers: np.ndarray) -> np.ndarray:
        """Distance of each query to each routing object."""
        return _distance(self.q @ routers.T, self.q2[:, None], (routers ** 2).sum(1)[None], self.most, False)

    def reached(self, to_routers: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Which (query, ball) can hold one of the query's k best."""
        return self.reach(np.arange(len(self.ids)), to_routers - radius[None]) >= self.floor[:, None]

    def batch(self, rows: list[dict], to_routers: np.ndarray, routers: np.ndarray) -> None:
        """Visit pages, the nearest ball first, but for those that no query can reach."""
        at, radius = np.array([r["router"] for r in rows]), np.array([r["page_radius"] for r in rows])
        width = self.q.shape[1]
        for i in np.argsort((to_routers[:, at] - radius[None]).min(0), kind="stable"):
            if not self.reached(to_routers[:, at[i]][:, None], radius[i:i + 1]).any():
                self.pages_skipped += 1
                continue
            row = rows[i]
            page = {name: np.array(row[name]) for name in ("starts", "radius", "to_page", "to_node")}
            page["whole"] = np.frombuffer(row["vecs"], "<i8").reshape(-1, width)
            page["vecs"] = page["whole"].astype(np.float64)
            page["routing"] = np.frombuffer(row["routing"], "<i8").reshape(-1, width).astype(np.float64)
            page["at"] = np.concatenate([[0], np.cumsum(row["many"])])
            self.page(page | {"router": routers[at[i]], "ids": row["ids"]})

    def page(self, page: dict) -> None:
        """Visit the page's nodes, each query best first, until none can reach the query's floor."""
        every = np.arange(len(self.ids))
        radius = page["radius"]
        bound = np.abs(self.to_routers(page["router"][None]) - page["to_page"][None]) - radius[None]
        bound = np.maximum(bound, 0)
        open_ = self.reach(every, bound) >= self.floor[:, None]
        to_node = np.full(bound.shape, np.inf)
        routing2 = (page["routing"] ** 2).sum(1)
        for j in np.nonzero(open_.any(0))[0]:
            rows = np.nonzero(open_[:, j])[0]
            to_node[rows, j] = _distance(self.q[rows] @ page["routing"][j], self.q2[rows], routing2[j],
                                         self.most, False)
            self.computed += len(rows)
        bound = np.maximum(to_node - radius[None], bound)
        order = np.argsort(bound, axis=1, kind="stable")
        for turn in range(bound.shape[1]):
            node = order[:, turn]
            nearest = bound[every, node]
            go = np.isfinite(nearest)
            go[go] = self.reach(every[go], nearest[go][:, None])[:, 0] >= self.floor[go]
            if not go.any():
                break
            for j in np.unique(node[go]):
                self._entries(page, j, np.nonzero(go & (node == j))[0], to_node)

    def _entries(self, page: dict, j: int, rows: np.ndarray, to_node: np.ndarray) -> None:
        first, last = page["starts"][j], page["starts"][j + 1]
        apart = np.abs(to_node[rows, j][:, None] - page["to_node"][first:last][None])
        cols = np.nonzero((self.reach(rows, apart) >= self.floor[rows][:, None]).any(0))[0]
        if not len(cols):
            return
        scores = self.q[rows] @ page["vecs"][first + cols].T
        self.computed += scores.size
        good = scores >= (self.floor[rows] - 2 * self.slack[rows])[:, None]
        for i in np.nonzero(good.any(1))[0]:
            r = rows[i]
            found, own = self.best[r], self.ids[r]
            query = None if self.exact else self.whole[r].tolist()
            for c in np.nonzero(good[i])[0]:
                e = first + cols[c]
                score = int(scores[i, c]) if self.exact else sum(map(operator.mul, query, page["whole"][e].tolist()))
                found.extend((-score, x) for x in page["ids"][page["at"][e]:page["at"][e + 1]] if x != own)
            found.sort()
            del found[self.k:]
            if len(found) == self.k:
                self.floor[r] = max(self.floor[r], -found[-1][0])


def _search(pages: DataFrame, shared, most: float, k: int) -> DataFrame:
    """(query_id, place, vec_id, score): per task the best of each query of the broadcast block.

    Scores are decimals, as they can be beyond a long; those beyond 38 digits tie.
    """
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, q, least, routers = shared.value
        searcher = Searcher(own_ids, q, least, most, k)
        to_routers = searcher.to_routers(routers)
        for batch in batches:
            searcher.batch(batch.to_pylist(), to_routers, routers)
        found = [(int(own_ids[i]), i, x, str(max(-DIGITS_38, min(DIGITS_38, -s)))) for i, best in enumerate(searcher.best) for s, x in best]
        columns = list(zip(*found)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
            names=["query_id", "place", "vec_id", "score"])

    found = pages.mapInArrow(searched, "query_id long, place long, vec_id long, score string")
    return found.withColumn("score", F.col("score").cast("decimal(38,0)"))


def search_block(index: Index, block: list, k: int) -> tuple[DataFrame, int]:
    """(query_id, place, vec_id, score) of the block, and the number of routing objects whose pages are not read."""
    spark, routers, most = index.pages.sparkSession, index.routers, index.most
    ids = np.array([r["vec_id"] for r in block], np.int64)
    queries = _integers([r["vec"] for r in block])
    scores = queries.astype(np.float64) @ routers.T
    floor = np.full(len(ids), -np.inf)
    for i, own in enumerate(ids.tolist()):  # the sample's k-th best score, its copies counted
        many = np.array([sum(x != own for x in xs) for xs in index.router_ids])
        order = np.argsort(-scores[i], kind="stable")
        enough = np.nonzero(np.cumsum(many[order]) >= k)[0]
        if len(enough):
            floor[i] = scores[i, order[enough[0]]]
    home = sorted({r["router"] for r in block})

    def searched(of: list[int]) -> DataFrame:
        shared = spark.sparkContext.broadcast((ids, queries, floor, routers))
        return _search(index.pages.where(F.col("router").isin(of)), shared, most, k)

    best = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    first = searched(home).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    first = materialize(first, "mtree-home")
    full = first.where(F.col("n") == k).select("place", "score").collect()  # a row per query of the block
    for row in full:
        floor[row["place"]] = max(floor[row["place"]], float(row["score"]))
    judge = Searcher(ids, queries, floor, most, k)
    open_ = judge.reached(judge.to_routers(routers), index.radius).any(0)
    rest = [r for r in np.nonzero(open_)[0].tolist() if r not in set(home)]
    found = first.drop("n")
    return (found.unionByName(searched(rest)) if rest else found), len(routers) - len(home) - len(rest)


def query_blocks(queries: DataFrame) -> list[F.Column]:
    """Conditions on (vec, router) that cut the queries into blocks of about ``BLOCK``, of few routing objects each."""
    blocks, near, held = [], [], 0
    for row in sorted(queries.groupBy("router").count().collect(), key=lambda r: r["router"]):
        if row["count"] > BLOCK:
            parts = -(-row["count"] // BLOCK)
            blocks += [(F.col("router") == row["router"]) & (F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == p)
                       for p in range(parts)]
            continue
        if held + row["count"] > BLOCK:
            blocks.append(F.col("router").isin(near))
            near, held = [], 0
        near, held = [*near, row["router"]], held + row["count"]
    return blocks + ([F.col("router").isin(near)] if near else [])


def top_k(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest products of each row whose id ``every`` divides.

    Candidates are all rows but those with the query's own id; equal scores go to
    the smaller id; a query gets fewer rows if there are fewer candidates.  Rows
    that repeat both id and vector count once.  Vectors that are null or hold null
    or non-finite components, and rows without id, take no part; an empty table
    gives an empty result.  Ranks follow the exact score; a score beyond a long is
    given as the nearest long.  Queries are sent to the tasks in blocks of about
    ``BLOCK``, so what the driver holds does not grow with the table.
    """
    spark = table.sparkSession
    vectors = materialize(scaled_vectors(table, id_col, vec_col), "mtree-vectors")
    queries = vectors.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    out = scratch_path(spark, "mtree-found")
    schema = "query_id long, rank int, vec_id long, score long"
    if queries.isEmpty():
        return spark.createDataFrame([], schema)
    index = build_index(materialize(distinct_points(vectors, k), "mtree-points"), k)
    queries = materialize(with_router(queries, index.shared, index.most), "mtree-queries")
    best = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    score = F.least(F.greatest("score", F.lit(-LONG - 1).cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)"))
    for condition in query_blocks(queries):
        if block := queries.where(condition).collect():
            found, _ = search_block(index, block, k)
            (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
             .select("query_id", "rank", "vec_id", score.cast("long").alias("score")).write.mode("append").parquet(out))
    return spark.read.schema(schema).parquet(out)
