"""Records made of the driver's tables by expressions that any SQL engine can repeat."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST = ("acme", "northern", "river", "delta", "summit", "cedar", "harbor", "pioneer", "crystal", "golden", "silver", "maple", "quantum")
SECOND = ("trading", "foods", "dental", "learning center", "services", "logistics", "bakery", "textiles", "motors", "studio", "pharma")
ENDINGS = ("Pvt Ltd", "Private Limited", "LLC", "Inc", "")
ROADS = ("park", "main", "station", "church", "market", "mill", "lake")
SHORT, LONG = ("Rd", "St", "Ave", "Blvd"), ("Road", "Street", "Avenue", "Boulevard")


def pick(values: tuple[str, ...], index: str) -> str:
    """SQL for the value at a 0-based index."""
    return f"CASE CAST({index} AS BIGINT) " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _fields(k: str, source: int) -> tuple[str, str, str]:
    kind = {1: pick(LONG, f"{k} % 4"), 2: pick(SHORT, f"{k} % 4"), 3: pick(LONG if source != 3 else SHORT, f"{k} % 4")}[source]
    name = f"concat({pick(FIRST, f'{k} % 13')}, ' ', {pick(SECOND, f'floor({k} / 13) % 11')}, ' ', {pick(ENDINGS, f'({k} + {source}) % 5')})"
    address = f"concat(CAST({k} % 997 AS VARCHAR(9)), ' ', {pick(ROADS, f'{k} % 7')}, ' ', {kind}, ', ', CAST(10000 + {k} % 400 AS VARCHAR(9)))"
    return f"concat('S{source}-', CAST({k} AS VARCHAR(20)))", name, address


#: SQL of the three sources: entity_id, business_name, business_address, country; equal keys are links.
RECORDS = " UNION ALL ".join(
    f"SELECT {i} AS entity_id, {n} AS business_name, {a} AS business_address, {land} AS country FROM {table}"
    for table, (i, n, a), land in (
        ("customer", _fields("c_custkey", 1), "CASE WHEN c_custkey % 50 = 0 THEN '' ELSE concat('land ', CAST(c_custkey % 7 AS VARCHAR(9))) END"),
        ("supplier", _fields("s_suppkey", 2), "concat('Land ', CAST(s_suppkey % 7 AS VARCHAR(9)))"),
        ("part", _fields("p_partkey", 3), "concat('land ', CAST((CASE WHEN p_partkey % 11 = 0 THEN p_partkey + 1 ELSE p_partkey END) % 7 AS VARCHAR(9)))"),
    )
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all three sources."""
    out = None
    for part, table in zip(RECORDS.split(" UNION ALL "), ("customer", "supplier", "part"), strict=True):
        select = part.removeprefix("SELECT ").rsplit(" FROM ", 1)[0]
        df = spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*_columns(select))
        out = df if out is None else out.unionByName(df)
    return out


def _columns(select: str) -> list[str]:
    """Splits a select list at its top-level commas."""
    out, depth, text, quoted = [], 0, "", False
    for c in select:
        quoted ^= c == "'"
        depth += (c == "(") - (c == ")") if not quoted else 0
        if c == "," and not depth and not quoted:
            out.append(text.strip())
            text = ""
        else:
            text += c
    return [*out, text.strip()]


def truth(all_records: DataFrame) -> DataFrame:
    """(s1, t): links by construction."""
    key = F.substring("entity_id", 4, 20)
    s1 = all_records.where(F.col("entity_id").startswith("S1-")).select(key.alias("k"), F.col("entity_id").alias("s1"))
    return s1.join(all_records.where(~F.col("entity_id").startswith("S1-")).select(key.alias("k"), F.col("entity_id").alias("t")), "k").select("s1", "t")
