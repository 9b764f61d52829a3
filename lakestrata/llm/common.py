"""Helpers shared by the corpus operators.

Row-wise operators add one struct column (parameter ``out``) to the documents they get and leave
every other column alone, so extra columns never clash with results; an existing column called
``out`` is replaced. ``fresh`` finds an unused name where a caller must not lose a column.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakestrata
from lakestrata.session import configure

# Arrow batches handed to Python workers: bounded in rows and in bytes, so a batch of very long
# documents stays small.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application), as --py-files would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(lakestrata.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="lakestrata-py-")) / "lakestrata_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))  # the driver serves it to every executor
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, bounded Arrow batches, and the package on the workers."""
    configure(spark)
    ship_package(spark)
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key as text, modulo ``m`` (a null key counts as the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % m


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A deterministic number in [0, 1) from the given columns, for bounded samples."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / float(1 << 30)


def fresh(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_column(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def release_memory() -> None:
    """Hand freed memory back to the system: a Python worker lives on, and the next stage's tasks need the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)  # glibc only
    except (AttributeError, OSError):
        pass


def text_map(ddl: str, factory: Callable[[], Callable[[list], pa.Array]]):
    """A vectorised text function: ``factory()`` runs once per task and gives a function from a
    list of texts to an Arrow array of type ``ddl``. Non-deterministic for the planner, so one call
    is never evaluated twice when several fields of its result are used."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = factory()
        for batch in batches:
            yield fn(batch.to_pylist())
        del fn
        release_memory()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, ddl).asNondeterministic()


def structs(fields: dict[str, tuple[list, pa.DataType]]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(v, t) for v, t in fields.values()], names=list(fields))


# Word bytes: A-Z lowered; a-z, digits and all bytes of non-ASCII characters kept; the rest separates.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def word_lists(text: str | None, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a whole text, in order, a list for about every ``piece`` bytes: a very long text is
    never held as one list of words."""
    data = (text or "").encode("utf-8").translate(WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def doc_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` cut back to the columns of ``like``, in their order."""
    return df.select(*[F.col(f"`{c}`") for c in like.columns])
