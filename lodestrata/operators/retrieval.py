"""Vector, keyword and hybrid retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators import cells


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two numeric arrays; null where a norm is 0."""
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def vector_topk(vectors: DataFrame, query: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", digits: int = 6) -> DataFrame:
    """Exact top-k by cosine against the one row of ``query`` (column ``query_vec``).

    The query side is one row by contract (``limit(1)``), so broadcasting it has a proven bound;
    ties break by id, and the plan ends in TakeOrderedAndProject, never a full sort.
    """
    one = F.broadcast(query.select("query_vec").limit(1))
    scored = vectors.filter(F.col(vec_col).isNotNull()).crossJoin(one).withColumn("score", F.round(cosine(F.col(vec_col), F.col("query_vec")), digits))
    return scored.drop("query_vec").orderBy(F.desc("score"), F.asc(id_col)).limit(k)


#: Queries of neighbours() that meet a block of vectors at a time, about.
MOST_QUERIES = 512


def keyword_search(docs: DataFrame, text_col: str, pattern: str, order: str, k: int) -> DataFrame:
    """Rows whose text is like the query, case folded; '%' and '_' in it stay wildcards. The k first by key."""
    return docs.filter(F.col(text_col).ilike(f"%{pattern}%")).orderBy(order).limit(k)


def parameter_search(records: DataFrame, doc: str, pattern: str, fields: dict[str, str], key: str, k: int) -> DataFrame:
    """(key and ``fields``, by JSON path) of records whose whole JSON text is like the query, case folded; the k first by key. Fields that a record lacks are null."""
    hits = keyword_search(records, doc, pattern, key, k)
    return hits.select(key, *[F.get_json_object(doc, path).alias(name) for name, path in fields.items()])


#: What a parameter hit shows of a record (fixed paths of the record format).
PARAMETER_FIELDS = {"material": "$.material.name", "framework": "$.constitutive_model.framework", "flow_rule": "$.plastic_parameters.flow_rule"}


def snippet(c: Column, n: int = 280) -> Column:
    return F.left(c, F.lit(n))


def hybrid(chunk_hits: DataFrame, parameter_hits: DataFrame) -> DataFrame:
    """Two result lists in one table, each row marked by its list; scores are not fused."""
    return chunk_hits.withColumn("hit_list", F.lit("chunk_hits")).unionByName(parameter_hits.withColumn("hit_list", F.lit("parameter_hits")), allowMissingColumns=True)


def evidence_prompt(hits: DataFrame, question: str, order: list[str], text: str) -> DataFrame:
    """One prompt with numbered evidence: [E1], [E2] and so on, in order."""
    x = F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("t"))))
    lines = F.transform(x, lambda r, i: F.concat(F.lit("[E"), (i + 1).cast("string"), F.lit("] "), r["t"]))
    return hits.agg(F.concat(F.lit(f"Question: {question}\n\nEvidence:\n"), F.array_join(lines, "\n")).alias("prompt"))


def neighbours(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", digits: int = 9) -> DataFrame:
    """(query_id, id, score, rank): the k nearest other vectors of each query row (columns query_id, query_vec).

    Queries and vectors are both tables of any size: they meet in the cells of an index
    (:mod:`lodestrata.operators.cells`), where bounds leave out what cannot be among the k.
    """
    found = cells.search(cells.build(vectors, id_col, vec_col), queries, k, digits, MOST_QUERIES)
    return found.select("query_id", F.col("id").alias(id_col), "score", "rank")


def json_search(rows: DataFrame, doc: str, pattern: str, paths: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows whose JSON text holds the pattern as a whole, or any of whose paths does, case ignored; ``path`` is the first such path, null where only the whole text matches."""
    like = lambda c: F.coalesce(c.ilike(f"%{pattern}%"), F.lit(False))
    at = F.coalesce(*[F.when(like(F.get_json_object(doc, p)), F.lit(p)) for p in paths])
    return rows.withColumn("path", at).filter(F.col("path").isNotNull() | like(F.col(doc))).orderBy(*order).limit(k)
