"""What the training-data operators share: reading tables, shared storage, and splitting text into words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: White space that separates words, as a Java and Python pattern.
SPACE = r"[\x20\x09-\x0D]+"
#: The same characters, for trim() and bytes.strip().
SPACE_CHARS = " \t\n\x0b\x0c\r"

_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. On one machine alone (a local master, as in
    tests) one is made and set where there is none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="codetables-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes df to a new Parquet table in the shared folder and reads it back. Later stages start from the files,
    so a lost executor costs no recomputation and each row is computed once; the shuffles behind it aren't needed any
    more and are removed at once."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/codetables/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame | None) -> None:
    """Deletes staged tables that nothing reads any more."""
    for made in tables:
        if made is None:
            continue
        jvm, conf = made.sparkSession.sparkContext._jvm, made.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in made.inputFiles()}:
            if "/codetables/" in folder:
                place = jvm.org.apache.hadoop.fs.Path(folder)
                place.getFileSystem(conf).delete(place, True)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of rows that a mapInArrow function returns as `ddl`."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def id_or_least(col: str | Column) -> Column:
    """A document's id for comparisons: rows without one count as one document before all others."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(-(1 << 63))).cast("long")


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound, for use inside one task."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_RANDOM = np.random.Generator(np.random.PCG64(20))
#: A random value for each byte, and the odd factor by which its place in a word counts.
_BYTES = _RANDOM.integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []

#: For each byte whether it separates words.
SPACE_BYTES = np.isin(np.arange(256), list(SPACE_CHARS.encode()))
#: Bytes of text that are hashed at once.
HASHED_AT_ONCE = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_FACTOR to the power of 0, 1, 2, ... and of 0, -1, -2, ... (modulo 2**64)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, HASHED_AT_ONCE + 1)
        one = np.ones(1, np.uint64)
        _POWERS[:] = [np.concatenate([one, np.full(size - 1, f, np.uint64)]).cumprod(dtype=np.uint64) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def _hashes_of(data: bytes, separates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of data: a polynomial of its bytes, from differences of one running sum."""
    b = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(separates[b].view(np.int8), prepend=1, append=1))
    first, end = edge[::2], edge[1::2]
    up, down = _powers(len(b))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * up[: len(b)], out=sums[1:])
    return mixed((sums[end] - sums[first]) * down[first]), first


def word_hashes(texts: list[bytes], separates: np.ndarray = SPACE_BYTES) -> Iterator[np.ndarray]:
    """The 64-bit hashes of the words of each text, in order. Short texts are hashed together; long ones in parts that
    end where a word ends."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > HASHED_AT_ONCE:
            data, parts, start = texts[at], [], 0
            while start < len(data):
                end = start + HASHED_AT_ONCE
                while end < len(data) and not separates[data[end]]:
                    end += 1
                parts.append(_hashes_of(data[start:end], separates)[0])
                start = end
            yield np.concatenate(parts)
            at += 1
            continue
        to, size = at, 0
        while to < len(texts) and size + len(texts[to]) <= HASHED_AT_ONCE:
            size += len(texts[to]) + 1
            to += 1
        ends = np.cumsum([len(t) + 1 for t in texts[at:to]])
        found, first = _hashes_of(b"\n".join(texts[at:to]), separates)
        begin = 0
        for stop in np.searchsorted(first, ends).tolist():
            yield found[begin:stop]
            begin = stop
        at = to


def to_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values, so that all their bits depend on all bits of x."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k consecutive word hashes; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = (out + h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's LONG."""
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
