"""Independent SQL (DuckDB dialect) for every registered query.

Written from the rule tables, not from the Spark code: window functions
(row_number, LAG) where the Spark side uses parallel numbering and map-side
aggregation, CASE chains where it uses route columns.
"""

from __future__ import annotations

import datetime as dt

from loadsmith.plans.fixtures import BATCH1, BATCH2, CONV_PAGE, DIM0_END, EMB_PAGE, PART_PAGE, REST, RUN1, RUN2


def lit_date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final


STATES = ("SELECT o_custkey AS ID, o_orderpriority AS City, o_orderstatus AS Email, "
          "CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders")


def latest(lo: dt.date | None, hi: dt.date | None) -> str:
    conds = []
    if lo is not None:
        conds.append(f"d >= {lit_date(lo)}")
    if hi is not None:
        conds.append(f"d < {lit_date(hi)}")
    where = " AND ".join(conds) or "TRUE"
    return (f"(SELECT s.ID, s.City, s.Email, s.d, c.c_name AS Name FROM "
            f"(SELECT * FROM ({STATES}) WHERE {where} "
            f"QUALIFY row_number() OVER (PARTITION BY ID ORDER BY d DESC, o_orderkey DESC) = 1) s "
            f"LEFT JOIN customer c ON c.c_custkey = s.ID)")


T6_DIM0 = ("SELECT CAST(row_number() OVER (ORDER BY ID) AS BIGINT) AS Emp_Key, ID, Name, "
           "City AS CURRENTCity, CAST(NULL AS VARCHAR) AS HESTORICALCity, Email AS CURRENTEmail, "
           "CAST(NULL AS VARCHAR) AS HESTORICALEmail, d AS STARTDate, CAST(NULL AS DATE) AS ENDDate, "
           f"1 AS Active_Flag FROM {latest(None, DIM0_END)}")

T6_COLS = ("ID, Name, CURRENTCity, HESTORICALCity, CURRENTEmail, HESTORICALEmail, "
           "STARTDate, ENDDate, Active_Flag")


def t6_batch(window=REST, null_city: bool = False) -> str:
    city = "CASE WHEN ID % 17 = 0 THEN NULL ELSE City END" if null_city else "City"
    return f"SELECT ID, Name, {city} AS City, Email, d AS Update_Date FROM {latest(*window)}"


def _chg(a: str, b: str, policy: str) -> str:
    if policy == "distinct":
        return f"CASE WHEN a.ID IS NOT NULL AND {a} IS DISTINCT FROM {b} THEN 1 ELSE 0 END"
    return f"CASE WHEN a.ID IS NOT NULL AND {a} <> {b} THEN 1 ELSE 0 END"


def active_first(dim: str) -> str:
    return (f"(SELECT * FROM {dim} WHERE Active_Flag = 1 "
            f"QUALIFY row_number() OVER (PARTITION BY ID ORDER BY Emp_Key) = 1)")


def t6_classify(batch: str, dim: str, policy: str = "ignore") -> str:
    cls = (f"SELECT b.*, a.Emp_Key AS d_Emp_Key, a.CURRENTCity AS d_CURRENTCity, "
           f"a.HESTORICALCity AS d_HESTORICALCity, a.CURRENTEmail AS d_CURRENTEmail, "
           f"a.HESTORICALEmail AS d_HESTORICALEmail, a.ID IS NOT NULL AS matched, "
           f"{_chg('b.City', 'a.CURRENTCity', policy)} AS chg_City, "
           f"{_chg('b.Email', 'a.CURRENTEmail', policy)} AS chg_Email "
           f"FROM {batch} b LEFT JOIN {active_first(dim)} a ON a.ID = b.ID")
    return (f"SELECT *, CASE WHEN NOT matched THEN 'new' WHEN chg_City + chg_Email = 0 THEN 'none' "
            f"WHEN chg_City + chg_Email = 2 THEN 'both' WHEN chg_City = 1 THEN 'city' "
            f"ELSE 'email' END AS route FROM ({cls})")


def t6_inserts(cls: str, run: dt.date) -> str:
    return ("SELECT ID, Name, City AS CURRENTCity, "
            "CASE WHEN route = 'new' THEN NULL WHEN chg_City = 1 THEN d_CURRENTCity "
            "ELSE d_HESTORICALCity END AS HESTORICALCity, Email AS CURRENTEmail, "
            "CASE WHEN route = 'new' THEN NULL WHEN chg_Email = 1 THEN d_CURRENTEmail "
            "ELSE d_HESTORICALEmail END AS HESTORICALEmail, "
            f"CASE WHEN route = 'new' THEN Update_Date ELSE {lit_date(run)} END AS STARTDate, "
            "CAST(NULL AS DATE) AS ENDDate, 1 AS Active_Flag, d_Emp_Key AS x_key "
            f"FROM {cls} WHERE route <> 'none'")


def t6_step(name: str, dim: str, batch: str, run: dt.date, policy: str = "ignore"):
    """CTEs {name}_cls, {name}_ins, {name}_keyed, {name}_next for one batch."""
    return [
        (f"{name}_cls", t6_classify(batch, dim, policy)),
        (f"{name}_ins", t6_inserts(f"{name}_cls", run)),
        (f"{name}_keyed",
         f"SELECT CAST((SELECT COALESCE(MAX(Emp_Key), 0) FROM {dim}) + row_number() OVER "
         f"(ORDER BY ID, STARTDate) AS BIGINT) AS Emp_Key, {T6_COLS} FROM {name}_ins"),
        (f"{name}_next",
         f"SELECT Emp_Key, ID, Name, CURRENTCity, HESTORICALCity, CURRENTEmail, HESTORICALEmail, "
         f"STARTDate, CASE WHEN Active_Flag = 1 AND Emp_Key IN (SELECT x_key FROM {name}_ins) "
         f"THEN {lit_date(run)} ELSE ENDDate END AS ENDDate, "
         f"CASE WHEN Active_Flag = 1 AND Emp_Key IN (SELECT x_key FROM {name}_ins) THEN 0 "
         f"ELSE Active_Flag END AS Active_Flag FROM {dim} "
         f"UNION ALL SELECT Emp_Key, {T6_COLS} FROM {name}_keyed"),
    ]


def t6_base_ctes(null_city: bool = False, policy: str = "ignore", window=REST, run: dt.date = RUN2):
    return [("dim0", T6_DIM0), ("b1", t6_batch(window, null_city))] + \
        t6_step("s1", "dim0", "b1", run, policy)


def t6_two_batch_ctes():
    return t6_base_ctes(window=BATCH1, run=RUN1) + [("b2", t6_batch(BATCH2))] + t6_step("s2", "s1_next", "b2", RUN2)


def t6_late(name: str, dim: str):
    """CTEs of late rows: every order dated before its customer's active version, put in its place."""
    tracked = "CURRENTCity IS DISTINCT FROM lag(CURRENTCity) OVER o OR CURRENTEmail IS DISTINCT FROM lag(CURRENTEmail) OVER o"

    def pair(now: str, was: str) -> str:
        return (f"CASE WHEN lag(1) OVER o IS NULL THEN {{'v': {was}}} WHEN {now} IS DISTINCT FROM lag({now}) OVER o "
                f"THEN {{'v': lag({now}) OVER o}} END")

    return [
        (f"{name}_all", f"SELECT s.* FROM ({NAMED_SOURCE}) s JOIN (SELECT ID, MIN(STARTDate) AS st FROM {dim} "
                        "WHERE Active_Flag = 1 GROUP BY ID) a ON a.ID = s.ID WHERE s.d < a.st "
                        "QUALIFY row_number() OVER (PARTITION BY s.ID, s.d ORDER BY s.o_orderkey DESC) = 1"),
        (f"{name}_ev", f"SELECT * FROM {dim} WHERE ID IN (SELECT ID FROM {name}_all) UNION ALL "
                       "SELECT NULL, ID, Name, City, NULL, Email, NULL, d, NULL, NULL "
                       f"FROM {name}_all l WHERE NOT EXISTS (SELECT 1 FROM {dim} x WHERE x.ID = l.ID AND x.STARTDate = l.d)"),
        (f"{name}_chg", f"SELECT *, CASE WHEN lag(1) OVER o IS NULL OR {tracked} THEN 1 ELSE 0 END AS c FROM {name}_ev "
                        "WINDOW o AS (PARTITION BY ID ORDER BY STARTDate, Emp_Key NULLS FIRST)"),
        (f"{name}_run", f"SELECT *, SUM(c) OVER (PARTITION BY ID ORDER BY STARTDate, Emp_Key NULLS FIRST) AS run FROM {name}_chg"),
        (f"{name}_told", f"SELECT *, MIN(STARTDate) OVER r AS first_start, "
                         "first_value(Emp_Key) OVER (PARTITION BY ID, run ORDER BY Emp_Key IS NULL, STARTDate, Emp_Key) AS known "
                         f"FROM {name}_run WINDOW r AS (PARTITION BY ID, run)"),
        (f"{name}_kept", "SELECT * REPLACE (CASE WHEN Emp_Key = known THEN first_start ELSE STARTDate END AS STARTDate) "
                         f"FROM {name}_told WHERE Emp_Key IS NOT NULL OR (known IS NULL AND STARTDate = first_start)"),
        (f"{name}_pairs", f"SELECT *, {pair('CURRENTCity', 'HESTORICALCity')} AS hc, "
                          f"{pair('CURRENTEmail', 'HESTORICALEmail')} AS he, lead(STARTDate) OVER o AS nxt FROM {name}_kept "
                          "WINDOW o AS (PARTITION BY ID ORDER BY STARTDate, Emp_Key NULLS FIRST)"),
        (f"{name}_chain", "SELECT Emp_Key, ID, Name, CURRENTCity, (last_value(hc IGNORE NULLS) OVER o).v AS HESTORICALCity, "
                          "CURRENTEmail, (last_value(he IGNORE NULLS) OVER o).v AS HESTORICALEmail, STARTDate, "
                          "COALESCE(nxt, ENDDate) AS ENDDate, CASE WHEN nxt IS NOT NULL THEN 0 ELSE Active_Flag END AS Active_Flag "
                          f"FROM {name}_pairs WINDOW o AS (PARTITION BY ID ORDER BY STARTDate, Emp_Key NULLS FIRST)"),
        (f"{name}_next", f"SELECT * FROM {dim} WHERE ID NOT IN (SELECT ID FROM {name}_all) UNION ALL "
                         f"SELECT * FROM {name}_chain WHERE Emp_Key IS NOT NULL UNION ALL "
                         f"SELECT CAST((SELECT MAX(Emp_Key) FROM {dim}) + row_number() OVER (ORDER BY ID, STARTDate) AS BIGINT), "
                         f"{T6_COLS} FROM {name}_chain WHERE Emp_Key IS NULL"),
    ]


# --- versioned -------------------------------------------------------------

V_DIM0 = ("SELECT CAST(row_number() OVER (ORDER BY ID) AS BIGINT) AS Emp_Key, ID, Name, City, Email, "
          "d AS Schedule_Date, 1 AS Active_Flag, CAST(ID % 5 + 1 AS INTEGER) AS Version_No "
          f"FROM {latest(None, DIM0_END)}")

V_COLS = "ID, Name, City, Email, Schedule_Date, Active_Flag, Version_No"


def v_batch(dim: str) -> str:
    return ("SELECT b.ID, b.Name, b.City, b.Email, CASE WHEN b.ID % 4 = 0 AND p.Schedule_Date "
            "IS NOT NULL THEN p.Schedule_Date ELSE b.d END AS Schedule_Date "
            f"FROM {latest(*REST)} b LEFT JOIN (SELECT ID, Schedule_Date FROM {dim} "
            "WHERE Active_Flag = 1) p ON p.ID = b.ID")


def v_classify(batch: str, dim: str) -> str:
    cls = (f"SELECT b.*, a.Emp_Key AS d_Emp_Key, a.Schedule_Date AS d_Schedule_Date, "
           f"a.Version_No AS d_Version_No, a.ID IS NOT NULL AS matched, "
           f"{_chg('b.Schedule_Date', 'a.Schedule_Date', 'ignore')} AS not_same_day "
           f"FROM {batch} b LEFT JOIN {active_first(dim)} a ON a.ID = b.ID")
    return (f"SELECT *, CASE WHEN NOT matched THEN 'new' WHEN not_same_day = 1 THEN 'changed' "
            f"ELSE 'same' END AS route FROM ({cls})")


def v_inserts(cls: str, rule: str = "reference") -> str:
    if rule == "conventional":  # changed date -> old + 1; same date -> nothing
        return ("SELECT ID, Name, City, Email, Schedule_Date, 1 AS Active_Flag, "
                "CAST(CASE WHEN route = 'changed' THEN d_Version_No + 1 ELSE 1 END AS INTEGER) "
                f"AS Version_No, d_Emp_Key AS x_key FROM {cls} WHERE route <> 'same'")
    return ("SELECT ID, Name, City, Email, Schedule_Date, 1 AS Active_Flag, "
            "CAST(CASE WHEN route = 'same' THEN d_Version_No + 1 ELSE 1 END AS INTEGER) AS Version_No, "
            f"d_Emp_Key AS x_key FROM {cls}")


def v_step(name: str, dim: str, batch: str, rule: str = "reference"):
    """CTEs {name}_cls, {name}_ins, {name}_keyed, {name}_next for one versioned batch."""
    return [
        (f"{name}_cls", v_classify(batch, dim)),
        (f"{name}_ins", v_inserts(f"{name}_cls", rule)),
        (f"{name}_keyed", f"SELECT CAST((SELECT COALESCE(MAX(Emp_Key), 0) FROM {dim}) + row_number() "
                          f"OVER (ORDER BY ID, Schedule_Date) AS BIGINT) AS Emp_Key, {V_COLS} "
                          f"FROM {name}_ins"),
        (f"{name}_next", "SELECT Emp_Key, ID, Name, City, Email, Schedule_Date, "
                         f"CASE WHEN Active_Flag = 1 AND Emp_Key IN (SELECT x_key FROM {name}_ins) "
                         f"THEN 0 ELSE Active_Flag END AS Active_Flag, Version_No FROM {dim} "
                         f"UNION ALL SELECT Emp_Key, {V_COLS} FROM {name}_keyed"),
    ]


def v_ctes():
    return [("vdim0", V_DIM0), ("vb1", v_batch("vdim0"))] + v_step("v", "vdim0", "vb1")


# --- job-level sources ----------------------------------------------------------

NAMED_SOURCE = ("SELECT s.o_custkey AS ID, c.c_name AS Name, s.o_orderpriority AS City, "
                "s.o_orderstatus AS Email, CAST(s.o_orderdate AS DATE) AS d, s.o_orderkey "
                "FROM orders s LEFT JOIN customer c ON c.c_custkey = s.o_custkey")


def job_batch(where: str, date_name: str) -> str:
    return (f"SELECT ID, Name, City, Email, d AS {date_name} FROM ({NAMED_SOURCE}) WHERE {where} "
            f"QUALIFY row_number() OVER (PARTITION BY ID ORDER BY d DESC, o_orderkey DESC) = 1")


# --- injected violations for the checks ----------------------------------------

def t6_injected(dim: str) -> list[tuple[str, str]]:
    base = (f"SELECT Emp_Key, ID, Name, CURRENTCity, CASE WHEN Active_Flag = 1 AND ID % 67 = 0 AND "
            f"HESTORICALCity IS NOT NULL THEN 'X' ELSE HESTORICALCity END AS HESTORICALCity, "
            f"CURRENTEmail, HESTORICALEmail, STARTDate, CASE WHEN Active_Flag = 1 AND ID % 59 = 0 "
            f"THEN {lit_date(RUN2)} WHEN Active_Flag = 0 AND ID % 61 = 0 THEN NULL ELSE ENDDate END "
            f"AS ENDDate, Active_Flag FROM {dim}")
    return [("inj_base", base),
            ("t6_checked", "SELECT * FROM inj_base UNION ALL "
                           "SELECT Emp_Key + 10000000 AS Emp_Key, ID, Name, CURRENTCity, HESTORICALCity, "
                           "CURRENTEmail, HESTORICALEmail, STARTDate, ENDDate, Active_Flag FROM inj_base "
                           "WHERE Active_Flag = 1 AND ID % 53 = 0 UNION ALL "
                           "SELECT * FROM inj_base WHERE Active_Flag = 0 AND ID % 71 = 0")]


def v_injected(dim: str) -> list[tuple[str, str]]:
    base = (f"SELECT Emp_Key, ID, Name, City, Email, Schedule_Date, Active_Flag, "
            f"CASE WHEN ID % 43 = 0 THEN 0 ELSE Version_No END AS Version_No FROM {dim}")
    return [("vinj_base", base),
            ("v_checked", "SELECT * FROM vinj_base UNION ALL "
                          "SELECT Emp_Key + 10000000 AS Emp_Key, ID, Name, City, Email, Schedule_Date, "
                          "Active_Flag, Version_No FROM vinj_base WHERE Active_Flag = 1 AND ID % 53 = 0 "
                          "UNION ALL SELECT * FROM vinj_base WHERE Active_Flag = 0 AND ID % 71 = 0")]


PRODUCTS = ("SELECT p_partkey AS id, p_name AS title, CAST(round(p_retailprice) AS BIGINT) AS price, "
            "CAST(p_size AS DOUBLE) AS discountPercentage, CAST(p_size AS BIGINT) AS stock, "
            "p_brand AS brand, p_type AS category, CAST(p_size AS DOUBLE) / 10 AS rating FROM part")

PRODUCTS_CHECKED = [
    ("prod", PRODUCTS),
    ("prod_base", "SELECT id, CASE WHEN id % 97 = 0 THEN NULL ELSE title END AS title, price, "
                  "CASE WHEN id % 89 = 0 THEN 101.0 ELSE discountPercentage END AS discountPercentage, "
                  "stock, brand, category, rating FROM prod"),
    ("prod_checked", "SELECT * FROM prod_base UNION ALL SELECT * FROM prod_base WHERE id % 83 = 0"),
]

