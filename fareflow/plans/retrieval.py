"""Retrieval: documents into chunks, exact nearest vectors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import top_per_group
from ..session import materialise

#: Bytes of query vectors that one scan of the corpus serves, and queries that are compared at once.
PASS_BYTES, BLOCK_QUERIES = 16 << 20, 256


def chunks(docs: DataFrame, words: int, overlap: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole texts cut into runs of ``words`` words; neighbours share ``overlap`` words."""
    step = words - overlap
    split = docs.select(doc_id, F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("_w"))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((F.size("_w") - overlap) / step).cast("int") - 1, F.lit(0)))
    return (split.filter(F.size("_w") > 0)
            .select(doc_id, "_w", F.explode(starts).alias("chunk"))
            .select(doc_id, "chunk",
                    F.array_join(F.slice("_w", F.col("chunk") * step + 1, words), " ").alias("chunk_text")))


def centroids(vectors: DataFrame, label: str, embedding: str) -> DataFrame:
    """Mean vector per label: positions are averaged, so a hot label folds before the shuffle."""
    cells = vectors.select(label, F.posexplode(embedding).alias("pos", "x"))
    means = cells.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    pairs = means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("p"))
    return pairs.select(F.col(label).alias("query_id"), F.col("p.x").alias("embedding"))


def nearest(corpus: DataFrame, queries: DataFrame, k: int, corpus_id: str = "vec_id",
            embedding: str = "embedding", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The ``k`` most similar corpus vectors for each query by cosine, ties by id.

    One scan of the corpus serves all queries up to ``pass_bytes`` of vectors, which is what a task
    holds of them; it compares them block by block and keeps k rows for each over all its rows, and the
    window merges the tasks' rows. Only a larger set of queries takes further scans, each written out before the next.
    """
    rows, width = queries.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    passes = max(1, -(-rows * (width or 0) * 8 // pass_bytes))
    part_of = F.pmod(F.xxhash64("query_id"), F.lit(passes))
    results = []
    for i in range(passes):
        part = queries.filter(part_of == i).select("query_id", "embedding").toPandas()
        found = top_per_group(_scan(corpus, part, k, corpus_id, embedding), ["query_id"],
                              ["-similarity", corpus_id], k, "row_number").withColumnRenamed("row_number", "rank")
        results.append(found if passes == 1 else materialise(found, "nearest"))
    return reduce(DataFrame.unionByName, results)


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype("float64")
    size = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(size == 0, 1, size)


def _scan(corpus: DataFrame, queries: pd.DataFrame, k: int, corpus_id: str, embedding: str) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(
        (queries["query_id"].to_numpy("int64"), _unit(queries["embedding"]) if len(queries) else None))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, q = shared.value
        # Rows of the best so far for each query: similarity and id, the best first.
        sims, ids = np.zeros((0, len(query_ids))), np.zeros((0, len(query_ids)), "int64")
        for pdf in batches:
            if not len(pdf) or q is None:
                continue
            x, own = _unit(pdf[embedding]), pdf[corpus_id].to_numpy("int64")
            kept = [], []
            for a in range(0, len(query_ids), BLOCK_QUERIES):
                block = slice(a, a + BLOCK_QUERIES)
                s = np.concatenate([sims[:, block], x @ q[block].T])
                v = np.concatenate([ids[:, block], np.broadcast_to(own[:, None], (len(own), s.shape[1]))])
                order = np.lexsort((v, -s), axis=0)[:k]
                kept[0].append(np.take_along_axis(s, order, axis=0))
                kept[1].append(np.take_along_axis(v, order, axis=0))
            sims, ids = np.concatenate(kept[0], axis=1), np.concatenate(kept[1], axis=1)
        yield pd.DataFrame({"query_id": np.tile(query_ids, len(sims)), corpus_id: ids.ravel(), "similarity": sims.ravel()})

    return corpus.select(corpus_id, embedding).mapInPandas(
        best, f"query_id long, {corpus_id} long, similarity double")
