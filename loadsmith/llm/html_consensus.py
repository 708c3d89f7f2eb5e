"""Main text of web pages by consensus host paths.

Each page scores its containers and votes for their generalised tag-class paths;
votes are summed per host in Spark; every page is then read again at the path
that its host has agreed on.  Inside it, blocks whose text stands on at least
half of the host's different pages are boilerplate and left out, unless they
are half of what is there (then the page is a copy).
"""

from __future__ import annotations

import heapq
import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.llm.common import in_slices
from loadsmith.llm.url_trie import split_url
from loadsmith.session import materialize

#: Containers that a page votes for, and paths kept per host (a page with none of them uses its own best).
PAGE_VOTES, HOST_PATHS = 5, 64
#: Share of the plain text of a page's own best container that the text at a host's path has to have.
FAIR_SHARE = 0.3
#: A block is boilerplate on at least so many different pages of its host that are this share of them.
REPEATED_PAGES, REPEATED_SHARE = 10, 0.5
#: Words of the shortest such block, and the share of the text at the chosen path from which all blocks stay.
BLOCK_WORDS, MOST_REPEATED = 3, 0.5
#: Links from which a list without other text is a menu.
MENU_LINKS = 3
#: Bytes of host paths up to which they are broadcast; beyond, the join shuffles.
BROADCAST_BYTES = 64 << 20

# Element names and words in class or id that mark what isn't the article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math canvas object xmp noframes".split())
_SKIP = frozenset("head nav footer aside button select dialog menu header label fieldset".split()) | _RAW
_CONTAINER = frozenset("body article main section div td".split())
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
_JUNK = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer footer login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget widgets".split())
#: Words that may stand beside those in one class token ("site-banner", "comments-area").
_PLACE = frozenset("site page main top bottom left right list box block area section inner outer container bar".split())
#: Of those words, the ones of readers' own writing, which may be longer than the article.
_READERS = frozenset("comment comments replies reply respond".split())
#: With any other words ("post-comments") they make a weak suspect, but for those that say how a wrapper looks or
#: that it holds the text.
_WEAK = (_JUNK | {"header"}) - {"widget", "widgets"}
_STATE = frozenset("has no with without free enabled disabled hide show is not open closed".split())
_HOLDS = frozenset("content text editor".split())
#: Share of a page's plain text that has to be left when elements are left out by such words.
LEAST_LEFT = 0.1
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("table ul ol dl td th article section div main body blockquote".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.DOTALL)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.IGNORECASE)
_ARIA = re.compile(r"\baria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_STYLE = re.compile(r"\bstyle\s*=\s*[\"'][^\"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")


def junk_words(value: str) -> set[str]:
    """Words of ``_JUNK`` in those tokens of a class, id or role that say nothing else ("has-sidebar" does)."""
    found = set()
    for token in value.split():
        words = set(_WORD.findall(token))
        if words and words <= _JUNK | _PLACE:
            found |= words & _JUNK
    return found


def weak_words(value: str) -> set[str]:
    """Words of ``_WEAK`` in tokens that also say something else, but not how a wrapper looks ("has-sidebar")."""
    found = set()
    for token in value.split():
        words = set(_WORD.findall(token))
        if not words & _STATE and (words & _READERS or not words & _HOLDS):
            found |= words & _WEAK
    return found


def is_hidden(attributes: str) -> bool:
    lower = attributes.lower()
    if "hidden" not in lower and "none" not in lower:
        return False
    return bool(_HIDDEN.search(_QUOTED.sub('""', attributes)) or _ARIA.search(attributes) or _STYLE.search(attributes))


class Page:
    """Text of a page outside menus and the like, and its containers.

    Elements with a junk word, hidden ones and forms are suspects: they are left out
    unless they hold a <main>, or the page's only articles, or nearly all of its text.
    Weak suspects also stay if they hold an h1 or more text than all else.  A list
    of links without other text is left out if the page has more plain text.

    ``parts``: text in page order, with a space at each block's edge;
    ``containers``: [path, first part, last part + 1, own characters, tag, the
    container around it, whether it has headings (2) or paragraphs (1) of its own].
    """

    def __init__(self, source: str):
        self.parts: list[str] = []
        self.sizes: list[int] = []  # characters outside links, per part
        self.containers: list[list] = []
        self._within: list[int] = []  # nearest container, per part
        self._prose: list[int] = []  # whether in a heading (2) or a paragraph (1), per part
        self._edges = bytearray()  # whether a block's edge, per part
        self._links = 0
        #: First part, last part + 1, suspect around it, by readers, holds a <main>, holds an article, kind,
        #: links before it (then in it), holds its heading.
        self._suspects: list[list] = []
        self._articles_outside = False
        self._read(source or "")
        self._leave_out()

    def _text(self, raw: str, stack: list) -> None:
        if stack and stack[-1][3]:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        self._edges.append(0)
        linked = any(s[0] == "a" for s in stack)
        n = 0 if linked else len(text.strip())
        self.sizes.append(n)
        self._within.append(stack[-1][2] if stack else -1)
        self._prose.append(self._prose_of(stack) if n else 0)

    @staticmethod
    def _prose_of(stack: list) -> int:
        """2 in a heading, 1 in another block of prose, else 0."""
        for name, *_ in reversed(stack):
            if name in _PROSE:
                return 2 if name[0] == "h" else 1
            if name in _BLOCK:
                return 0
        return 0

    def _edge(self) -> None:
        if self.parts and not self._edges[-1]:
            self.parts.append(" ")
            self._edges.append(1)
            self.sizes.append(0)
            self._within.append(-1)
            self._prose.append(0)

    def _close(self, stack: list, to: int) -> None:
        for _, _, at, _, opened, suspect, suspected in reversed(stack[to:]):
            if opened:
                self.containers[at][2] = len(self.parts)
            if suspected:
                self._suspects[suspect][1] = len(self.parts)
                self._suspects[suspect][7] = self._links - self._suspects[suspect][7]
        del stack[to:]

    def _read(self, source: str) -> None:
        #: Open elements: name, path, index of the nearest container, whether left out, whether it is that container,
        #: index of the nearest suspect, whether it is that suspect.
        stack: list[tuple[str, str, int, bool, bool, int, bool]] = []
        at, end = 0, len(source)
        while at < end:
            found = _TAG.search(source, at)
            if not found:
                self._text(source[at:], stack)
                break
            if found.start() > at:
                self._text(source[at:found.start()], stack)
            at = found.end()
            name = (found[2] or found[5] or "").lower()
            if not name:
                continue
            if name in _BLOCK:
                self._edge()
            if found[1] or found[4]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        self._close(stack, i)
                        break
                continue
            attributes = found[3] or found[6] or ""
            if name in _RAW:
                closing = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(source, at)
                if attributes.rstrip().endswith("/") and name in ("svg", "math"):
                    continue
                if closing is None:
                    at = end
                else:
                    shut = source.find(">", closing.end())
                    at = end if shut < 0 else shut + 1
                continue
            if name in _VOID or name == "html":
                continue
            if name in _BLOCK:
                self._close_implied(stack, name)
            self._open(stack, name, attributes)
        self._close(stack, 0)

    def _close_implied(self, stack: list, name: str) -> None:
        ends = _CLOSES.get(name, {"p"})
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ends:
                self._close(stack, i)
                return
            if stack[i][0] in _SCOPE:
                return

    def _open(self, stack: list, name: str, attributes: str) -> None:
        _, path, container, left_out, _, suspect, _ = stack[-1] if stack else ("", "", -1, False, False, -1, False)
        classes, words, junk, weak, main, hidden = "", set(), set(), set(), name == "main", False
        self._links += name == "a"
        if attributes:
            for key, *value in _NAMES.findall(attributes):
                value = "".join(value).lower()
                words.update(_WORD.findall(value))
                junk |= junk_words(value)
                weak |= weak_words(value)
                main = main or key.lower() == "role" and value.strip() == "main"
                if key.lower() == "class":
                    classes = ".".join(sorted({_NUMBER.sub("#", c) for c in value.split()}))
            hidden = is_hidden(attributes)
        left_out = left_out or name in _SKIP and not (
            name == "header" and ("article" in path or any(s[0] == "main" for s in stack)))
        if not left_out and (main or name == "article" and not words & _JUNK):
            self._articles_outside = self._articles_outside or suspect < 0
            at, flag = suspect, 4 if main else 5
            while at >= 0 and not self._suspects[at][flag]:
                self._suspects[at][flag] = True
                at = self._suspects[at][2]
        if name in ("h1", "h2") and not left_out:
            at = suspect
            while at >= 0 and not self._suspects[at][8]:
                self._suspects[at][8] = name == "h1" or self._suspects[at][6] == "header"
                at = self._suspects[at][2]
        kind = ""
        if not left_out and not main and name not in ("body", "article"):
            kind = ("junk" if junk or hidden or name == "form" else "header" if weak == {"header"} else
                    "weak" if weak else "list" if name in ("ul", "ol") else "")
        suspected = bool(kind)
        if suspected:
            self._suspects.append([len(self.parts), len(self.parts), suspect, bool((junk | weak) & _READERS), False,
                                   False, kind, self._links, False])
            suspect = len(self._suspects) - 1
        if name in _BLOCK and name != "br":
            path = f"{path}>{name}" + (f".{classes}" if classes else "")
        opens = name in _CONTAINER and not left_out
        if opens:
            around, container = container, len(self.containers)
            self.containers.append([path, len(self.parts), len(self.parts), 0, name, around, 0])
        stack.append((name, path, container, left_out, opens, suspect, suspected))

    def _sums(self) -> list[int]:
        total, sums = 0, [0]
        for n in self.sizes:
            total += n
            sums.append(total)
        return sums

    def _leave_out(self) -> None:
        """Decides on the suspects, drops what is left out, and counts the containers' own characters."""
        sums = self._sums()
        plain = [sums[s[1]] - sums[s[0]] for s in self._suspects]
        inside: dict[int, list[int]] = {}
        for i, s in enumerate(self._suspects):
            inside.setdefault(s[2], []).append(i)
        out: set[int] = set()  # outermost ones

        def consider(look: list[int]) -> None:
            while look:
                i = look.pop()
                if self._stays(i, plain[i], sums[-1]):
                    look += inside.get(i, [])
                else:
                    out.add(i)

        consider(inside.get(-1, [])[:])
        left = sums[-1] - sum(plain[i] for i in out)
        # The largest first, until enough is left; what stands inside it is still left out.
        waiting = [(-plain[i], i) for i in out if self._may_stay(i)]
        heapq.heapify(waiting)
        while waiting and (left < LEAST_LEFT * sums[-1] or
                           self._suspects[waiting[0][1]][6] in ("weak", "header") and -waiting[0][0] > left
                           and not self._suspects[waiting[0][1]][3]):
            n, i = heapq.heappop(waiting)
            out.remove(i)
            left -= n
            before = set(out)
            consider(inside.get(i, [])[:])
            for j in out - before:
                left -= plain[j]
                if self._may_stay(j):
                    heapq.heappush(waiting, (-plain[j], j))
        gone = bytearray(len(self.parts))
        for i in out:
            first, last = self._suspects[i][:2]
            gone[first:last] = b"\1" * (last - first)
        if out and any(p.strip() and not g for p, g in zip(self.parts, gone)):
            self.parts = [" " if e else "" if g else p for p, g, e in zip(self.parts, gone, self._edges)]
            self.sizes = [0 if g else n for n, g in zip(self.sizes, gone)]
        for n, at, prose in zip(self.sizes, self._within, self._prose):
            if n and at >= 0:
                self.containers[at][3] += n
                self.containers[at][6] = max(self.containers[at][6], prose)

    def _stays(self, i: int, plain: int, all_plain: int) -> bool:
        """Whether a suspect is none, by what it holds."""
        first, last, _, readers, main, article, kind, links, heading = self._suspects[i]
        if kind == "list":
            return plain > 0 or links < MENU_LINKS or sum(len(p.strip()) for p in self.parts[first:last]) >= all_plain
        return main or article and not self._articles_outside or heading and not readers and kind != "junk"

    def _may_stay(self, i: int) -> bool:
        """Whether a suspect may stay for want of other text: not what readers clearly wrote."""
        return not self._suspects[i][3] or self._suspects[i][6] != "junk"

    def blocks(self, first: int = 0, last: int | None = None) -> Iterator[tuple[int, int, int]]:
        """(first part, last part + 1, 64-bit hash) of the blocks of at least ``BLOCK_WORDS`` words that are no headings."""
        last = len(self.parts) if last is None else last
        at = first
        while at < last:
            edge = self._edges.find(1, at, last)
            end = last if edge < 0 else edge
            if end > at:
                words = "".join(self.parts[at:end]).split()
                if len(words) >= BLOCK_WORDS and max(self._prose[at:end]) < 2:
                    yield at, end, xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)
            at = end + 1

    def scored(self) -> list[tuple[float, str]]:
        """(score, path) of the containers: plain text of their own, plus a share of what is deeper.

        A container with headings or paragraphs of its own has the best score of
        those right inside it and its own text on top, unless most of its text is
        elsewhere, so that it outdoes its sections; the body only for a heading
        and with a tenth elsewhere.  Nothing outdoes an article or <main> so.
        """
        sums = self._sums()
        found: dict[str, float] = {}
        plain: dict[str, int] = {}
        around: dict[str, set[str]] = {}
        prose: dict[str, int] = {}
        tags: dict[str, str] = {}
        for path, first, last, own, tag, at, has_prose in self.containers:
            deep = sums[last] - sums[first]
            score = deep if tag in ("article", "main") else own + (0.25 if tag == "body" else 0.5) * (deep - own)
            found[path] = found.get(path, 0.0) + score
            plain[path] = plain.get(path, 0) + deep
            prose[path] = prose.get(path, 0) + (own if has_prose > (tag == "body") else 0)
            tags[path] = tag
            if at >= 0:
                around.setdefault(self.containers[at][0], set()).add(path)
        # Deepest first: a container's path begins with that of the one around it.
        for path in sorted(around, key=len, reverse=True):
            if not prose[path] or tags[path] in ("article", "main"):
                continue
            best = max(sorted(around[path]), key=lambda p: found[p])
            other = plain[path] - prose[path] - plain[best]
            if found[best] > 0 and tags[best] not in ("article", "main") and other <= (0.1 if tags[path] == "body" else 1) * plain[best]:
                found[path] = max(found[path], found[best] + prose[path])
        return sorted(((s, p) for p, s in found.items() if s > 0), key=lambda x: (-x[0], x[1]))

    def text_at(self, path: str, repeated: frozenset[int] = frozenset()) -> str:
        """Text of all containers with this path, in page order; those inside another such one count once."""
        spans, done = [], 0
        for p, first, last, *_ in self.containers:
            if p == path and last > done:
                spans.append((max(first, done), last))
                done = last
        return self._joined(spans, repeated)

    def _joined(self, spans: list[tuple[int, int]], repeated: frozenset[int]) -> str:
        """Text of spans of parts without the blocks of ``repeated`` hashes, unless those are most of it."""
        whole = " ".join(" ".join("".join(self.parts[a:b]) for a, b in spans).split())
        if not repeated or not whole:
            return whole
        kept = []
        for first, last in spans:
            at = first
            for a, b, found in self.blocks(first, last):
                if found in repeated:
                    kept.append("".join(self.parts[at:a]))
                    at = b
            kept.append("".join(self.parts[at:last]))
        rest = " ".join(" ".join(kept).split())
        return rest if len(rest) > MOST_REPEATED * len(whole) else whole

    def text(self, paths: list[str], weak: Iterable[str] = (), repeated: frozenset[int] = frozenset()) -> str:
        """Text at the first of ``paths``, none of them the body, that holds a fair share of this page's text.

        Else that at the page's own best container, or all of it.  If that best
        path is one of ``weak``, which mostly lose where they stand, the first of
        ``paths`` with plain text is taken whatever its share.
        """
        sums = self._sums()
        plain: dict[str, int] = {}
        for path, first, last, _, tag, *_ in self.containers:
            if tag != "body":
                plain[path] = plain.get(path, 0) + sums[last] - sums[first]
        scored = self.scored()
        if scored:
            best = scored[0][1]
            least = 1 if best in weak else FAIR_SHARE * sum(
                sums[c[2]] - sums[c[1]] for c in self.containers if c[0] == best)
            chosen = next((p for p in paths if plain.get(p, 0) and plain[p] >= least), best)
            return self.text_at(chosen, repeated)
        for path in paths:
            if path in plain and (text := self.text_at(path, repeated)):
                return text
        return self._joined([(0, len(self.parts))], repeated)


def page_votes(pages: DataFrame) -> DataFrame:
    """(host, path, vote, seen, best, block, page), two kinds of rows.

    With a path: each page deals one vote among its best containers by score.
    ``seen`` counts the pages that vote for a path, ``best`` those that put it first.
    With a block's hash (0: the page as such) and a page's, path null: the block stands on it.
    """
    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast: dict[tuple[str, str], list] = {}
            held: set[tuple[str, int, int]] = set()
            for url, source in zip(batch.column(0), batch.column(1)):
                raw = source.as_py()
                page = Page(raw)
                found = page.scored()[:PAGE_VOTES]
                whole = sum(s for s, _ in found)
                host = split_url(url.as_py())[0]
                for i, (score, path) in enumerate(found):
                    sums = cast.setdefault((host, path), [0.0, 0, 0])
                    sums[0] += score / whole
                    sums[1] += 1
                    sums[2] += i == 0
                own = xxhash.xxh3_64_intdigest(raw or "") - (1 << 63)
                held.update((host, block, own) for _, _, block in page.blocks())
                held.add((host, 0, own))
            stands = list(zip(*held)) or [[], [], []]
            hosts, paths = ([k[i] for k in cast] for i in (0, 1))
            vote, seen, best = ([v[i] for v in cast.values()] for i in (0, 1, 2))
            none, no = [None] * len(held), [None] * len(cast)
            for slice_ in in_slices([hosts + list(stands[0]), paths + none, vote + none, seen + none, best + none,
                                     no + list(stands[1]), no + list(stands[2])]):
                kinds = (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(slice_, kinds)],
                                                 names=["host", "path", "vote", "seen", "best", "block", "page"])

    return pages.select("url", "html").mapInArrow(
        votes, "host string, path string, vote double, seen long, best long, block long, page long")


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths, weak, repeated): a host's paths in descending order of votes, ``HOST_PATHS`` at most.

    A page with none of these uses its own best container.  ``weak`` has those of
    them that are the best one on fewer than half of the pages that vote for them;
    ``repeated`` the hashes of blocks on ``REPEATED_SHARE`` and ``REPEATED_PAGES`` of
    the host's different pages, so no more than a few pages hold.
    """
    votes = materialize(page_votes(pages), "html-votes")
    summed = votes.where("path is not null").groupBy("host", "path").agg(
        F.round(F.sum("vote"), 6).alias("vote"), (F.sum("best") * 2 < F.sum("seen")).alias("weak"))
    order = Window.partitionBy("host").orderBy(F.desc("vote"), "path")
    ranked = summed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HOST_PATHS)
    kept = F.sort_array(F.collect_list(F.struct("place", "path", "weak")))
    agreed = ranked.groupBy("host").agg(kept.alias("kept")).select(
        "host", F.transform("kept", lambda x: x["path"]).alias("paths"),
        F.transform(F.filter("kept", lambda x: x["weak"]), lambda x: x["path"]).alias("weak"))
    held = votes.where("path is null").select("host", "block", "page").distinct().groupBy("host", "block").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= REPEATED_PAGES)
    all_ = held.where("block = 0").select("host", F.col("n").alias("pages"))
    often = held.where("block <> 0").join(all_, "host").where(F.col("n") >= F.lit(REPEATED_SHARE) * F.col("pages"))
    return agreed.join(often.groupBy("host").agg(F.sort_array(F.collect_list("block")).alias("repeated")), "host", "left")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    A null html is empty; an empty or textless page has the text ''.  A null url,
    or one without ``://``, belongs to the host ''.  Repeated rows are each
    returned (and each vote); ties between paths go to the first in order.  The
    whole html is read both times.  Other columns are not carried.  Host paths
    are broadcast up to ``BROADCAST_BYTES``, counted; beyond it the join shuffles.
    Repeated blocks are known by 64-bit hashes.
    """
    agreed = materialize(host_paths(pages), "html-paths")
    chars = F.aggregate("paths", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p) + 32)
    size = agreed.agg(F.sum(chars * 2 + 8 * F.coalesce(F.array_size("repeated"), F.lit(0)) + 100)).first()[0] or 0
    agreed = F.broadcast(agreed) if size <= BROADCAST_BYTES else agreed
    host = F.when(F.col("url").contains("://"),
                  F.translate(F.regexp_extract("url", r"(?s)://([^/?#]*)", 1),
                              "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")
    rows = pages.select("page_id", "url", "html", F.coalesce(host, F.lit("")).alias("host"))
    joined = rows.join(agreed, "host", "left").select("page_id", "url", "html", "paths", "weak", "repeated")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [Page(source.as_py()).text(paths.as_py() or [], weak.as_py() or [], frozenset(repeated.as_py() or ()))
                   for source, paths, weak, repeated in zip(*batch.columns[2:6])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")


__all__ = ["Page", "page_votes", "host_paths", "extract_main_text"]
