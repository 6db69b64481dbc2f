"""External models as injected functions, applied in Arrow batches; a deterministic stub stands in for tests."""

from __future__ import annotations

import hashlib
import json
import threading
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETRYABLE_STATUS = frozenset({408, 409, 429, 500, 502, 503, 504})


def with_retry(f: Callable, *args, attempts: int = 4, first: float = 1.0, most: float = 20.0, sleep: Callable[[float], None] = time.sleep):
    """Calls ``f``; errors with a retryable status, time-outs and lost connections are tried again after doubling waits."""
    wait = first
    for k in range(attempts):
        try:
            return f(*args)
        except Exception as e:
            status = getattr(e, "status_code", getattr(e, "code", None))
            if k + 1 == attempts or not (status in RETRYABLE_STATUS or isinstance(e, (TimeoutError, ConnectionError))):
                raise
            sleep(min(wait, most))
            wait *= 2
    return None


def stub_embedder(dim: int = 16) -> Callable[[Sequence[str]], list[list[float]]]:
    """Fixed pseudo-random unit vectors of the texts."""

    def embed(texts: Sequence[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.random.default_rng(int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big")).normal(size=dim)
            out.append((v / np.linalg.norm(v)).tolist())
        return out

    return embed


def digest_embedder(dim: int = 16) -> Callable[[Sequence[str]], list[list[float]]]:
    """The first bytes of each text's SHA-256, from -1 to below 1: vectors that SQL can make too."""
    return lambda texts: [[(b - 128) / 128 for b in hashlib.sha256(t.encode()).digest()[:dim]] for t in texts]


class Pace:
    """Lets at most ``per_second`` calls begin in a second, across the threads of one task; 0 sets no limit."""

    def __init__(self, per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.next, self.clock, self.sleep, self.lock = 1 / per_second if per_second else 0.0, 0.0, clock, sleep, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.next)
            self.next = start + self.gap
        if start > now:
            self.sleep(start - now)


def once_per_text(rows: DataFrame, key: str, text: str, call: Callable[[Sequence[str]], list], kind: str, cache: str, batch: int = 1, workers: int = 4, per_second: float = 0.0) -> DataFrame:
    """(key, result): ``call`` on each distinct text of the rows, kept under ``cache`` by the text's SHA-256, so that a rerun and a repeated text are not paid for again.

    ``call`` takes up to ``batch`` texts and gives a result for each. In a task ``workers`` calls run at a
    time, begun at ``per_second`` at most (0: no limit), so the whole rate is that times the tasks that run.
    Failed calls are tried again as in ``with_retry``; where one fails for good, what other tasks finished is
    not lost, since each stores its results. A null text counts as an empty one.
    """
    spark = rows.sparkSession
    named = rows.select(key, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).withColumn("_digest", F.sha2("_text", 256))
    schema = f"digest string, result {kind}"
    have = spark.read.schema(schema).parquet(cache) if _exists(spark, cache) else spark.createDataFrame([], schema)
    todo = named.groupBy("_digest").agg(F.first("_text").alias("_text")).join(have.select(F.col("digest").alias("_digest")), "_digest", "left_anti")
    result = spark.createDataFrame([], schema).schema["result"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        pace, arrow = Pace(per_second), to_arrow_type(result)

        def one(texts: list[str]) -> list:
            pace.wait()
            got = with_retry(call, texts)
            if len(got) != len(texts):
                raise ValueError(f"{len(texts)} texts, {len(got)} results")
            return got

        with ThreadPoolExecutor(workers) as pool:
            for b in batches:
                for at in range(0, b.num_rows, batch * workers):
                    part = b.slice(at, batch * workers)
                    texts = part.column(1).to_pylist()
                    made = [x for xs in pool.map(one, [texts[k : k + batch] for k in range(0, len(texts), batch)]) for x in xs]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, arrow)], ["digest", "result"])

    todo.select("_digest", "_text").mapInArrow(run, schema).write.mode("append").parquet(cache)
    kept = spark.read.schema(schema).parquet(cache).dropDuplicates(["digest"])
    return named.join(kept, named["_digest"] == kept["digest"]).select(key, "result")


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def embed_texts(rows: DataFrame, key: str, text: str, embedder: Callable[[Sequence[str]], list[list[float]]], dim: int, batch: int = 64) -> DataFrame:
    """(key, embedding), ``batch`` texts a call, with retries; a vector of another length is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, batch):
                part = b.slice(k, batch)
                vectors = with_retry(embedder, [t or "" for t in part.column(1).to_pylist()])
                if any(len(v) != dim for v in vectors):
                    raise ValueError(f"the embedder's vectors should have {dim} numbers")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vectors, pa.list_(pa.float32()))], [key, "embedding"])

    return rows.select(key, text).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, embedding array<float>")


def call_model(rows: DataFrame, key: str, prompt: str, model: Callable[[str], str], validate: Callable[[dict], list[str]] | None = None, attempts: int = 3) -> DataFrame:
    """(key, answer, errors): a model's JSON answer to each prompt. An answer that is no JSON or fails ``validate`` is asked for again with its errors; the last one is kept with them."""

    def one(p: str) -> tuple[str | None, list[str]]:
        ask, answer, errors = p, None, ["no prompt"]
        for _ in range(attempts if p else 0):
            answer = with_retry(model, ask)
            try:
                got = json.loads(answer)
                errors = validate(got) if validate else []
            except (TypeError, ValueError):
                errors = ["the answer is not JSON"]
            if not errors:
                break
            ask = f"{p}\n\nThe last answer had these errors:\n" + "\n".join(errors)
        return answer, errors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [one(p) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([a for a, _ in got], pa.string()), pa.array([e for _, e in got], pa.list_(pa.string()))], [key, "answer", "errors"])

    return rows.select(key, prompt).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, answer string, errors array<string>")
