"""Bronze ingest: landing files and reading them with explicit schemas.

Raw feeds are JSON. A single JSON *array* file cannot be split, so it is
read by one task; ``multiline=True`` supports that form for small inputs,
while at scale records are landed as JSON Lines (or page envelope files),
which Spark splits across tasks.

Landed files go under the session's shared checkpoint folder
(``spark.checkpoint.dir``) so every executor can read them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake import schemas
from safetylake.operators.paging import pages_to_read, verify_pages
from safetylake.session import scratch_path, snapshot
from safetylake.sources import json_array

SOURCES = {
    "products": (schemas.RAW_PRODUCTS, schemas.SOURCE_PRODUCTS, "product_ndc"),
    "enforcement": (schemas.RAW_ENFORCEMENT, schemas.SOURCE_ENFORCEMENT, "recall_number"),
    "adverse": (schemas.RAW_ADVERSE, schemas.SOURCE_ADVERSE, "safetyreportid"),
}


#: Holds the text of a record that does not parse.
CORRUPT = "_corrupt_record"


def tag(df: DataFrame, source: str) -> DataFrame:
    """Ingestion metadata: load time and source name."""
    return df.withColumn("_ingestion_ts", F.current_timestamp()).withColumn("_source", F.lit(source))


def bronze(spark: SparkSession, path: str, schema: T.StructType, source: str,
           multiline: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Read raw JSON records with a declared schema and tag them.

    Fields absent from the files read as NULL; malformed lines become NULL
    rows (PERMISSIVE) and are then removed by the silver drop rules. With
    ``keep_corrupt`` their text stays in ``_corrupt_record``, so that quality
    metrics can count them.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if multiline:
        reader = reader.option("multiLine", True)
    return tag(reader.json(path), source)


#: Holds the whole record, declared fields or not.
RECORD = "_record"


def bronze_records(spark: SparkSession, path: str, schema: T.StructType, source: str, arrays: bool = False) -> DataFrame:
    """Bronze rows that keep the whole raw record as VARIANT beside the declared columns.

    Nothing upstream sends is lost: a field that no schema declares can be read
    later by ``projected``, and ``schema_drift`` reports it. Records come one to a
    line, or in JSON array files (``arrays``), which many tasks read. Text that
    is no JSON stays in ``_corrupt_record`` with a null record.
    """
    lines = json_array.read(spark, path) if arrays else spark.read.text(path).filter(F.trim("value") != "")
    typed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = lines.select(F.from_json("value", typed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"),
                        F.try_parse_json("value").alias(RECORD))
    return tag(rows.select("r.*", RECORD), source)


def projected(bronze_rows: DataFrame, fields: dict[str, tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """Columns read from the whole record: name -> (path, type), e.g. ``{"maker": ("$.openfda.maker", "string")}``.

    ``keep`` names declared columns to keep. Values of another type become NULL.
    """
    return bronze_rows.select(*(keep or []), *[F.try_variant_get(RECORD, where, kind).alias(name)
                                               for name, (where, kind) in fields.items()])


def _paths(kind: T.DataType, at: str = "") -> dict[str, str]:
    """Path -> type name of a schema and all that is nested in it; ``[]`` steps into an array."""
    here = {at: "struct" if isinstance(kind, T.StructType) else "array" if isinstance(kind, T.ArrayType) else kind.simpleString()} if at else {}
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            here |= _paths(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, T.ArrayType):
        here |= _paths(kind.elementType, f"{at}[]")
    return here


def schema_drift(bronze_rows: DataFrame, declared: T.StructType, source: str) -> DataFrame:
    """How the records differ from the declared schema: ``source, path, declared, found, change``.

    ``new`` paths hold data that no column shows, ``missing`` ones are in no
    record, ``retyped`` ones hold another type than declared (or more than one:
    ``variant``). Paths that are only ever null are no change, and neither is what
    lies in a path that is new or missing itself. The records' types are merged
    by a distributed aggregate into one schema, which is all that comes back.
    """
    spark = bronze_rows.sparkSession
    text = bronze_rows.agg(F.schema_of_variant_agg(RECORD)).first()[0] or "VOID"
    found = _paths(T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")))
    want = _paths(declared)
    void = {p for p, t in found.items() if t == "void"}

    def inside(path: str, others: set[str]) -> bool:
        return any(path.startswith((f"{o}.", f"{o}[]")) for o in others)

    new = {p for p in found.keys() - want.keys() if p not in void}
    missing = want.keys() - found.keys()
    rows = [(p, None, found[p], "new") for p in new if not inside(p, new)]
    rows += [(p, want[p], None, "missing") for p in missing if not inside(p, missing) and not inside(p, void)]
    rows += [(p, want[p], found[p], "retyped") for p in found.keys() & want.keys() if p not in void and found[p] != want[p]]
    return spark.createDataFrame([(source, *r) for r in sorted(rows)], "source string, path string, declared string, found string, change string")


#: Rows of a landed file at most: one task reads a compressed file.
ROWS_A_FILE = 100_000


def land_json(df: DataFrame, path: str) -> str:
    """Full-refresh landing: replace whatever is at ``path`` with ``df`` as JSON Lines, compressed (about a tenth of the text)."""
    (df.write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=ROWS_A_FILE)
     .option("zlib.compress.level", "BEST_SPEED").json(path))
    return path


def land_all(jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent landing jobs from driver threads so Spark executes them
    side by side; returns each job's result by name."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def land_source(spark: SparkSession, raw: DataFrame, which: str) -> DataFrame:
    """Write ``raw`` records as JSON Lines to the shared folder and read them back as bronze."""
    schema, source, _ = SOURCES[which]
    path = land_json(raw.select(*schema.fieldNames()), scratch_path(spark, f"landing-{which}"))
    return bronze(spark, path, schema, source)


def envelope_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("skip", T.LongType()),
        T.StructField("results", T.ArrayType(schema)),
        T.StructField(CORRUPT, T.StringType()),
    ])


def land_pages(spark: SparkSession, path: str, which: str, limit: int | None = None,
               page_size: int = 100) -> DataFrame:
    """Bronze records from page envelope files, read as a sequential paged
    client would: pages until the first short page, starting below ``limit``.
    No cap by default; ``limit=1000`` reproduces a capped pull. A missing,
    repeated or unreadable page up to the stop fails the landing, and so does a
    feed whose last page is full: the client would have asked for one more.
    The envelopes are parsed once and written; checks and records read that."""
    schema, source, _ = SOURCES[which]
    env = snapshot(spark.read.schema(envelope_schema(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(path),
                   f"envelopes-{which}")
    verify_pages(env, limit, page_size, CORRUPT)
    pages = pages_to_read(env, limit, page_size)
    return tag(pages.select(F.inline("results")), source)


def landing_counts(landed: dict[str, DataFrame]) -> DataFrame:
    """Landed record count per source name; a source without records counts 0."""
    out = None
    for source, df in landed.items():
        one = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(source).alias("_source"), "records")
        out = one if out is None else out.unionByName(one)
    return out


def as_json_text(df: DataFrame) -> DataFrame:
    """Nested columns rendered as JSON text (NULL fields kept), for display and
    order-stable comparison of raw records; the load time is dropped."""
    cols = []
    for f in df.schema.fields:
        if f.name == "_ingestion_ts":
            continue
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name), {"ignoreNullFields": "false"}).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
