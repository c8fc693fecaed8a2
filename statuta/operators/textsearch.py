"""Ranked search by weighted terms."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.session import spread

_TERM = r"[^0-9A-Za-z가-힣]+"
#: Distinct terms that every task may hold; with more, texts and queries are joined by term.
VOCABULARY = 2_000_000
#: Queries of one pass over the texts, and texts that a task looks at together.
QUERY_BLOCK, TEXT_BLOCK = 50_000, 50_000


def words(text_col: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text_col, F.lit(""))), _TERM), lambda w: w != "")


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, term, tf of every term of every text."""
    return docs.select(id_col, F.explode(words(text_col)).alias("term")).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_search(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """qid, id, score, rank: the ``k`` texts most like each query.

    Terms weigh tf * ln((1 + n) / (1 + df)) + tf; scores are cosines to six
    places.  Queries (in blocks, one pass over the texts for each) and the
    terms' weights are broadcast; texts stay where they are read, and ``k`` rows
    a query leave a task's block of them.
    """
    spark = docs.sparkSession
    tallied = docs.select(F.explode(F.array_distinct(words(text_col))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counts = tallied.limit(VOCABULARY + 1).toArrow()
    if counts.num_rows > VOCABULARY:
        return joined_by_term(docs, queries, k, id_col, text_col)
    n = docs.count()
    idf = {t: math.log((1.0 + n) / (1.0 + c)) + 1.0 for t, c in zip(counts.column("term").to_pylist(), counts.column("df").to_pylist())}
    passes = max(1, -(-queries.count() // QUERY_BLOCK))
    schema = f"qid {queries.schema['qid'].dataType.simpleString()}, {id_col} {docs.schema[id_col].dataType.simpleString()}, score double"
    texts = spread(docs.select(id_col, text_col), id_col).select(id_col, words(text_col).alias("words"))
    scored = None
    for block in range(passes):
        mine = queries.where(F.pmod(F.xxhash64("qid"), F.lit(passes)) == block).select("qid", words("query").alias("words"))
        part = texts.mapInArrow(_scorer(spark, mine, idf, k, id_col), schema)
        scored = part if scored is None else scored.unionByName(part)
    order = Window.partitionBy("qid").orderBy(F.desc("score"), id_col)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scorer(spark: SparkSession, queries: DataFrame, idf: dict[str, float], k: int, id_col: str):  # noqa: ANN202
    """What a task does with its texts: the ``k`` best of each block of them for each of ``queries``."""
    asked = queries.toArrow()
    weights = []
    for words_of in asked.column("words").to_pylist():
        tf = Counter(w for w in words_of if w in idf)
        one = {w: c * idf[w] for w, c in tf.items()}
        weights.append((one, math.sqrt(sum(x * x for x in one.values()))))
    shared = spark.sparkContext.broadcast((asked.column("qid"), weights, idf))
    limit = TEXT_BLOCK

    def run(batches):  # noqa: ANN001
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        qids, weights, idf = shared.value
        qids = qids.combine_chunks()
        code = {t: i for i, t in enumerate(idf)}
        idfs = np.fromiter(idf.values(), float, len(idf))
        queries = [(np.array([code[t] for t in one], dtype=np.int64), list(one.values()), norm) for one, norm in weights]

        def counted(batch):  # noqa: ANN001
            """Text (by place), term and tf of every term in a batch."""
            column = batch.column("words")
            known = column.flatten().dictionary_encode()
            terms = np.array([code[t] for t in known.dictionary.to_pylist()], dtype=np.int64)[known.indices.to_numpy()]
            sizes = np.diff(column.offsets.to_numpy())
            both, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(idfs) + terms, return_counts=True)
            return both // len(idfs), both % len(idfs), tf

        def best(held):  # noqa: ANN001
            ids = pa.chunked_array([b.column(id_col) for b, _ in held]).combine_chunks()
            starts = np.cumsum([0] + [b.num_rows for b, _ in held])
            text = np.concatenate([c[0] + at for (_, c), at in zip(held, starts)])
            term = np.concatenate([c[1] for _, c in held])
            w = np.concatenate([c[2] for _, c in held]) * idfs[term]
            norms = np.sqrt(np.bincount(text, w * w, len(ids)))
            order = np.argsort(term, kind="stable")
            text, term, w = text[order], term[order], (w / norms[text])[order]
            ends = np.searchsorted(term, np.arange(len(idfs) + 1))
            # ids of any type, by their order
            by_id = np.empty(len(ids), np.int64)
            by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
            found = []
            for q, (terms, qw, norm) in enumerate(queries):
                sums = np.zeros(len(ids))
                for t, x in zip(terms, qw):
                    at = slice(ends[t], ends[t + 1])
                    sums[text[at]] += w[at] * x
                cut = np.partition(sums, len(sums) - k)[len(sums) - k] if len(sums) > k else 0.0
                near = np.nonzero((sums > 0) & (sums >= cut - 2e-6 * norm))[0]
                if not len(near):
                    continue
                score = np.floor(sums[near] / norm * 1e6 + 0.5) / 1e6
                first = np.lexsort((by_id[near], -score))[:k]
                found.append((np.full(len(first), q), near[first], score[first]))
            q, i, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
            return pa.RecordBatch.from_arrays([qids.take(pa.array(q)), ids.take(pa.array(i)), pa.array(score)], names=["qid", id_col, "score"])

        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.select([id_col]), counted(batch)))
            size += batch.num_rows
            if size >= limit:
                yield best(held)
                held, size = [], 0
        if held:
            yield best(held)

    return run


def joined_by_term(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same by joins, for more terms than a task may hold; only texts that share a term with a query are touched."""
    terms = term_counts(docs, id_col, text_col)
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(n)).select(
        "term", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf")
    )
    weighted = terms.join(df, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    asked = term_counts(queries, "qid", "query").join(df, "term").select("qid", "term", (F.col("tf") * F.col("idf")).alias("qw"))
    q_norm = asked.groupBy("qid").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("q_norm"))
    dots = weighted.join(asked, "term").groupBy("qid", id_col).agg(F.sum(F.col("w") * F.col("qw")).alias("dot"))
    scored = dots.join(norms, id_col).join(q_norm, "qid").select("qid", id_col, F.round(F.col("dot") / F.col("norm") / F.col("q_norm"), 6).alias("score"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), id_col)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
