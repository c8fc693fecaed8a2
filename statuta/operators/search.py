"""Hybrid retrieval: exact nearest neighbours, citations, references, re-ranking.

All questions of a batch are answered in one plan.  Units meet the questions
of their law by an equi-join, so no pair of different laws is ever formed;
neighbours are cut to the needed number before the shuffle (the ranking filter
becomes a group limit), and everything after works on candidates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import text as X
from statuta.functions import vectors as V
from statuta.operators import units as U
from statuta.session import durable, stored

#: Questions (some hundred bytes each) that are broadcast at most.
STATED = 200_000
#: Neighbours fetched for each one returned, and the distance of injected units.
OVERFETCH, FAR = 20, 1e9


#: Pairs of a list of units and its law's questions, such lists in a task, and questions in a list.
LISTED, LISTS, ASKED_BLOCK = 2_000_000, 16, 64

#: Queries and corpus vectors that one task holds at a time.
QUERY_BLOCK, CORPUS_BLOCK = 2_048, 50_000


def nearest(
    corpus: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", cosine: bool = False
) -> DataFrame:
    """qid, id, dist, rank: the ``k`` nearest corpus vectors of each query, exactly.

    A stated query set (qid, q) against all rows, in blocks: every block of
    queries meets every block of the corpus once, as one task that multiplies
    two matrices and keeps ``k`` rows a query; these are merged per query.
    ``dist`` is the squared Euclidean distance, or one minus the cosine.  Ties go
    to the smaller id.
    """
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    n_c = max(1, -(-corpus.count() // CORPUS_BLOCK))
    id_type = corpus.schema[id_col].dataType.simpleString()
    qid_type = queries.schema["qid"].dataType.simpleString()
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("qid", "q", F.pmod(F.xxhash64("qid"), F.lit(n_q)).cast("int").alias("qb"), blocks(n_c).alias("cb"))
    right = corpus.select(
        F.col(id_col).alias("id"), F.col(vec_col).alias("v"), F.pmod(F.xxhash64(id_col), F.lit(n_c)).cast("int").alias("cb"), blocks(n_q).alias("qb")
    )

    def run(q, c):  # noqa: ANN001
        import numpy as np
        import pandas as pd

        empty = pd.DataFrame({"qid": q["qid"].iloc[:0], "id": c["id"].iloc[:0], "dist": np.zeros(0)})
        if not len(q) or not len(c):
            return empty
        a, b = np.stack(q["q"].to_numpy()).astype(float), np.stack(c["v"].to_numpy()).astype(float)
        ids = c["id"].to_numpy()
        if cosine:
            a = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
            b = b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        out = []
        squares = (b * b).sum(axis=1)
        for at in range(0, len(a), 256):
            part = a[at : at + 256]
            dist = 1 - part @ b.T if cosine else (part * part).sum(axis=1)[:, None] + squares - 2 * (part @ b.T)
            keep = min(len(b), k)
            cut = np.partition(dist, keep - 1, axis=1)[:, keep - 1]
            for row, limit, qid, vector in zip(dist, cut, q["qid"].iloc[at : at + 256], part):
                near = np.nonzero(row <= limit + 1e-9)[0]
                exact = row[near] if cosine else ((b[near] - vector) ** 2).sum(axis=1)
                order = np.lexsort((ids[near], exact))[:k]
                out.append(pd.DataFrame({"qid": qid, "id": ids[near][order], "dist": exact[order]}))
        return pd.concat(out, ignore_index=True)

    scored = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(run, f"qid {qid_type}, id {id_type}, dist double")
    order = Window.partitionBy("qid").orderBy("dist", "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumnRenamed("id", id_col)


def embed_input() -> Column:
    """What a unit is embedded by: its title over its text."""
    return X.strip(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit(""))))


# What questions look at; texts and titles are fetched for the answers only.
_INDEXED = ("mst", "level", "annex_no", "jo", "jo_norm", "hang_norm", "mok_norm", "annex_refs", "effective_date")
_SHOWN = ("path", "display_path_norm")
#: Days that stand for an unknown begin and an unknown cutoff: either way a unit holds.
ALWAYS, EVER = -(2**31), 2**31 - 1


def entries(units: DataFrame, *more: str, vectors: bool = True) -> DataFrame:
    """Keys and numbers of normalised units, the article they go by (``own``), the day
    they hold from (``since``), and, with ``vectors``, their vector ``v``."""
    return units.select(
        *_INDEXED,
        *more,
        own_article().alias("own"),
        F.coalesce(F.unix_date(X.as_of_date(F.col("effective_date"))), F.lit(ALWAYS)).alias("since"),
        *([V.hash_embedding_batch(embed_input()).alias("v")] if vectors else []),
    )


def indexed(units: DataFrame, *more: str) -> DataFrame:
    """The search index: the entries of units that carry ``faiss_id``.

    It is written once, without texts; questions only read it.
    """
    return stored(entries(units, "faiss_id", *more))


def own_article() -> Column:
    return X.strip(F.coalesce(F.col("jo_norm"), F.col("jo"), F.lit("")))


def asked_units(units: DataFrame, queries: DataFrame) -> DataFrame:
    """The units of the laws that are asked about; no question sees others."""
    laws = queries.select("mst").distinct()
    return units.join(F.broadcast(laws) if laws.count() <= STATED else laws, "mst", "left_semi")


def asked_about(queries: DataFrame, vectors: bool = True) -> DataFrame:
    """qid, mst, the last day ``until``, the citation ``c`` and, with ``vectors``, the vector ``q`` of each question, written once."""
    until = F.coalesce(F.unix_date(X.as_of_date(F.col("as_of"))), F.lit(EVER)).alias("until")
    text = F.col("query")
    return stored(queries.select("qid", "mst", until, X.citation(X.strip(text)).alias("c"), *([V.hash_embedding_batch(text).alias("q")] if vectors else [])))


def pairs_by_key(units: DataFrame, asked: DataFrame, unit_keys: Column, asked_keys: Column) -> DataFrame:
    """Each unit with the questions of its law that have a key in common with it, once for each such key.

    Keys are arrays of text.  Up to ``STATED`` questions are broadcast.
    """
    keyed = asked.withColumn("key", F.explode(F.array_distinct(F.array_compact(asked_keys))))
    own = units.withColumn("key", F.explode(F.array_distinct(F.array_compact(unit_keys))))
    return own.join(F.broadcast(keyed) if asked.count() <= STATED else keyed, ["mst", "key"])


def _tag(tag: str, value: Column) -> Column:
    return F.concat(F.lit(tag), value.cast("string"))


def _cite() -> list[Column]:
    return [F.col("c.jo"), F.col("c.hang"), F.col("c.mok")]


def _asked_key(*otherwise: Column) -> Column:
    """A question's most telling part: its article, else its paragraph, else its item."""
    return F.array(F.coalesce(_tag("j", X.filled(F.col("c.jo"))), _tag("h", F.col("c.hang")), _tag("m", F.col("c.mok")), *otherwise))


def exact_pairs(units: DataFrame, asked: DataFrame) -> DataFrame:
    """Units (with ``own``) and the questions of which they bear every cited part."""
    keys = F.array(_tag("j", F.col("own")), _tag("h", F.col("hang_norm")), _tag("m", F.col("mok_norm")))
    return pairs_by_key(units, asked, keys, _asked_key()).where(U.matches_all(*_cite()))


def strict_pairs(units: DataFrame, asked: DataFrame) -> DataFrame:
    """Units (with ``own`` and ``since``) and the questions of which they bear two parts and hold at the date."""
    keys = F.array(_tag("j", F.col("own")), _tag("x", F.concat_ws(",", F.col("hang_norm").cast("string"), F.col("mok_norm").cast("string"))))
    both = F.when(F.col("c.hang").isNotNull() & F.col("c.mok").isNotNull(), _tag("x", F.concat_ws(",", F.col("c.hang").cast("string"), F.col("c.mok").cast("string"))))
    found = pairs_by_key(units, asked, keys, F.array(_tag("j", X.filled(F.col("c.jo"))), both))
    once = F.startswith("key", F.lit("j")) | ~F.coalesce(F.col("own") == F.col("c.jo"), F.lit(False))
    return found.where((F.col("since") <= F.col("until")) & once & (U.match_count(*_cite()) >= 2))


def lenient_pairs(units: DataFrame, asked: DataFrame, uncited: bool = False) -> DataFrame:
    """Units (with ``shown`` paths) and the questions they match leniently.

    With ``uncited``, questions that cite nothing get every unit of their law.
    """
    path = F.coalesce(X.filled(F.col("display_path_norm")), F.col("path"), F.lit(""))

    def borne(tag: str, own: list[Column], part: str, unit: str) -> Column:
        shown = F.regexp_extract_all(path, F.lit(f"제({part}){unit}"), F.lit(1))
        return F.transform(F.concat(F.array(*(c.cast("string") for c in own)), shown), lambda x: _tag(tag, x))

    keys = F.concat(
        borne("j", [F.col("jo"), F.col("jo_norm")], r"\d+(?:의\d+)?", "조"),
        borne("h", [F.col("hang_norm")], r"\d+", "항"),
        borne("m", [F.col("mok_norm")], r"\d+", "호"),
        F.array(*([F.lit("")] if uncited else [F.lit(None).cast("string")])),
    )
    return pairs_by_key(units, asked, keys, _asked_key(*([F.lit("")] if uncited else []))).where(U.matches_leniently(*_cite()))


def valid_pairs(units: DataFrame, asked: DataFrame) -> DataFrame:
    """qid, unit_id: each unit (with ``since``) and the questions of its law (with ``qid``) at whose date it holds.

    The result grows with the square of a law, so one of more than ``LISTED``
    pairs is kept as lists of units of one first day and of questions of one
    last day.  Where the days fit, all pairs of two lists are valid, and they
    come as equal stretches, which columnar files keep in a small part of the
    space.  Lists are cut and dealt into tasks by their number of pairs.
    """
    units = stored(units.select("unit_id", "mst", "since"))
    asked = asked.select("qid", "mst", "until")
    sizes = units.groupBy("mst").agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy("mst").agg(F.count(F.lit(1)).alias("m")), "mst")
    hot = sizes.where(F.col("n") * F.col("m") > LISTED).select("mst", F.ceil(F.col("n") * F.col("m") / LISTED).cast("int").alias("cuts"))
    rows = hot.collect()
    hot = F.broadcast(units.sparkSession.createDataFrame(rows, hot.schema))
    held = F.col("since") <= F.col("until")
    few = units.join(hot, "mst", "left_anti").join(asked, "mst").where(held).select("qid", "unit_id")
    if not rows:
        return few
    by = ["mst", "since", "cut"]
    cut = units.join(hot, "mst").select("unit_id", "mst", "since", F.pmod(F.xxhash64("unit_id"), F.col("cuts")).alias("cut"))
    dealt = cut.repartition(max(-(-sum(r["cuts"] for r in rows) // LISTS), units.sparkSession.sparkContext.defaultParallelism), *by)
    own = dealt.groupBy(*by).agg(F.collect_list(F.struct("unit_id")).alias("own"))
    place = F.row_number().over(Window.partitionBy("mst", "until").orderBy("qid"))
    block = F.floor((place - 1) / ASKED_BLOCK).alias("block")
    blocks = asked.join(hot, "mst", "left_semi").select("*", block).groupBy("mst", "until", "block").agg(F.collect_list("qid").alias("qids"))
    # Compiled code holds all rows that come of one of its rows; transform isn't compiled with the rest, so these are a block's, not a list's.
    ids = F.explode(F.transform("own", lambda u: u["unit_id"])).alias("unit_id")
    listed = own.join(F.broadcast(blocks), "mst").where(held).select("qids", ids)
    return few.unionByName(listed.select(F.explode("qids").alias("qid"), "unit_id"))


def considered(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Each unit with each question of its law: distance, validity, citation matches.

    The search itself forms no such pairs; this is its plain statement for small tables.  Up to ``STATED`` questions are broadcast, so units stay where they are read
    and a law that holds many of them is no hot key; more are joined by law.
    """
    asked = durable(
        queries.select("qid", "mst", "as_of", V.hash_embedding_batch(F.col("query")).alias("q"), X.citation(X.strip(F.col("query"))).alias("c"))
    )
    cite = [F.col("c.jo"), F.col("c.hang"), F.col("c.mok")]
    return index.join(F.broadcast(asked) if asked.count() <= STATED else asked, "mst").select(
        "*",
        V.squared_distance(F.col("v"), F.col("q")).alias("dist"),
        U.active_as_of(F.col("as_of")).alias("active"),
        U.match_count(*cite).alias("matches"),
        U.matches_all(*cite).alias("exact"),
    ).drop("v", "q")


# What ``near_units`` says of a pair.
JO, HANG, MOK, ACTIVE, EXACT, IS_ANNEX, NO_JO = 1, 2, 4, 8, 16, 32, 64


def _bit(bit: int) -> Column:
    return F.col("bits").bitwiseAND(F.lit(bit)) != 0


def near_units(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """qid, mst, faiss_id, dist, bits: at least the ``k`` units of its law nearest to each question, exactly.

    Laws are dealt into tasks by hash; one with more units or questions than a
    block is cut, and every block of its questions meets every block of its
    units.  A task multiplies matrices in single precision, takes what is near
    the ``k``-th distance, and measures that again in double precision.
    """
    sizes = index.groupBy("mst").agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy("mst").agg(F.count(F.lit(1)).alias("m")), "mst")
    hot = sizes.where((F.col("n") > CORPUS_BLOCK) | (F.col("m") > QUERY_BLOCK)).select(
        "mst", F.ceil(F.col("n") / CORPUS_BLOCK).cast("int").alias("cn"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("qn")
    )
    hot = F.broadcast(index.sparkSession.createDataFrame(hot.collect(), hot.schema))
    buckets = max(1, index.count() // (CORPUS_BLOCK // 2))

    def dealt(rows: DataFrame, mine: str, other: str, by: str) -> DataFrame:
        rows = rows.where("mst is not null").join(hot, "mst", "left").withColumn("cut", F.col("cn").isNotNull())
        rows = rows.fillna(1, ["cn", "qn"]).withColumn("g", F.xxhash64("mst"))
        return rows.withColumns(
            {
                "g": F.when(F.col("cut"), F.col("g")).otherwise(F.pmod("g", F.lit(buckets))),
                f"{mine}b": F.pmod(F.xxhash64(by), F.col(f"{mine}n")).cast("int"),
                f"{other}b": F.explode(F.sequence(F.lit(0), F.col(f"{other}n") - 1)),
            }
        ).drop("cut", "cn", "qn")

    jo = X.filled(F.col("c.jo"))
    given = jo.isNotNull() | (F.coalesce("c.hang", F.lit(0)) != 0) | (F.coalesce("c.mok", F.lit(0)) != 0)
    need = sum((F.when(c.isNotNull(), bit).otherwise(0) for c, bit in ((jo, JO), (F.col("c.hang"), HANG), (F.col("c.mok"), MOK))), F.lit(0))
    left = dealt(
        asked.select("qid", "mst", "q", "until", jo.alias("jo"), F.col("c.hang").alias("hang"), F.col("c.mok").alias("mok"), need.alias("need"), given.alias("given")),
        "q", "c", "qid",
    )
    right = dealt(
        index.select(
            "mst", "faiss_id", "v", "since", F.col("own").alias("jo"), F.col("hang_norm").alias("hang"), F.col("mok_norm").alias("mok"),
            F.coalesce(F.col("level").isin(*U.ANNEX), F.lit(False)).alias("annex"),
        ),
        "c", "q", "faiss_id",
    )
    jo_bit, hang_bit, mok_bit, active_bit, exact_bit, annex_bit, no_jo_bit = JO, HANG, MOK, ACTIVE, EXACT, IS_ANNEX, NO_JO

    def run(q, u):  # noqa: ANN001
        import numpy as np
        import pyarrow as pa

        def vectors(t, name):  # noqa: ANN001
            return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

        def numbers(t, name, missing):  # noqa: ANN001
            return t.column(name).fill_null(missing).to_numpy()

        def codes(name):  # noqa: ANN001
            both = pa.chunked_array(q.column(name).chunks + u.column(name).chunks, pa.string()).combine_chunks().dictionary_encode().indices
            both = both.fill_null(-1).to_numpy()
            return both[: q.num_rows], both[q.num_rows :]

        rows, cols, dists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if q.num_rows and u.num_rows:
            a, b, ids = vectors(q, "q"), vectors(u, "v"), u.column("faiss_id").to_numpy()
            q_law, u_law = codes("mst")
            q_order, u_order = np.argsort(q_law, kind="stable"), np.argsort(u_law, kind="stable")
            laws, q_from = np.unique(q_law[q_order], return_index=True)
            q_to = np.append(q_from[1:], len(q_order))
            u_from, u_to = (np.searchsorted(u_law[u_order], laws, side) for side in ("left", "right"))
            for i in np.nonzero(u_to > u_from)[0]:
                asks, own = q_order[q_from[i] : q_to[i]], u_order[u_from[i] : u_to[i]]
                step = max(1, 4_000_000 // len(own))
                if len(own) > k:
                    wide, squares = np.ascontiguousarray(b[own].T), (b[own] ** 2).sum(axis=1)
                for at in range(0, len(asks), step):
                    part = asks[at : at + step]
                    if len(own) > k:
                        rough = squares - 2 * (a[part] @ wide)
                        limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] + np.float32(1e-4)
                        r, c = np.nonzero(rough <= limit)
                    else:
                        r, c = np.repeat(np.arange(len(part)), len(own)), np.tile(np.arange(len(own)), len(part))
                    r, c = part[r], own[c]
                    dist = np.zeros(len(r))
                    for x in range(a.shape[1]):
                        gap = b[c, x].astype(float) - a[r, x].astype(float)
                        dist += gap * gap
                    if len(own) > k:
                        order = np.lexsort((ids[c], dist, r))
                        r, c, dist = r[order], c[order], dist[order]
                        first = np.append(True, r[1:] != r[:-1])
                        place = np.arange(len(r)) - np.maximum.accumulate(np.where(first, np.arange(len(r)), 0))
                        r, c, dist = r[place < k], c[place < k], dist[place < k]
                    rows.append(r)
                    cols.append(c)
                    dists.append(dist)
        r, c = np.concatenate(rows), np.concatenate(cols)
        q_jo, u_jo = codes("jo")
        q_hang, q_mok, u_hang, u_mok = numbers(q, "hang", -1), numbers(q, "mok", -1), numbers(u, "hang", -2), numbers(u, "mok", -2)
        bits = jo_bit * ((q_jo[r] == u_jo[c]) & (q_jo[r] >= 0)) + hang_bit * (q_hang[r] == u_hang[c]) + mok_bit * (q_mok[r] == u_mok[c])
        need = q.column("need").to_numpy()[r]
        bits = bits + exact_bit * (((bits & need) == need) & numbers(q, "given", False)[r])
        bits = bits + active_bit * (u.column("since").to_numpy()[c] <= q.column("until").to_numpy()[r])
        bits = bits + annex_bit * numbers(u, "annex", False)[c] + no_jo_bit * (need & jo_bit == 0)
        out = [q.column("qid").take(pa.array(r)), u.column("mst").take(pa.array(c)), u.column("faiss_id").take(pa.array(c))]
        out += [pa.array(np.concatenate(dists)), pa.array(bits.astype(np.int32))]
        return pa.table(dict(zip(("qid", "mst", "faiss_id", "dist", "bits"), out)))

    qid_type, id_type = (t.schema[c].dataType.simpleString() for t, c in ((asked, "qid"), (index, "faiss_id")))
    by = ("g", "cb", "qb")
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, f"qid {qid_type}, mst string, faiss_id {id_type}, dist double, bits int")


def _near(index: DataFrame, asked: DataFrame, top_k: int) -> DataFrame:
    """``near_units`` cut to the over-fetched number of each question, with ``raw_rank``."""
    order = Window.partitionBy("qid").orderBy("dist", "faiss_id")
    found = near_units(index, asked, OVERFETCH * top_k)
    return found.withColumn("raw_rank", F.row_number().over(order)).where(F.col("raw_rank") <= OVERFETCH * top_k)


def candidates(index: DataFrame, queries: DataFrame, top_k: int, strict: bool = False, require_jo: bool = False) -> DataFrame:
    """qid, mst, faiss_id of the neighbours, promoted units and referenced annexes of each question, each once.

    Columns beside: distance, seed_rank, stage (0 neighbour, 1 promoted, 2 annex),
    matches, active, is_promoted, is_target.  No step forms the pairs of a law's
    units and questions in Spark: neighbours come from ``near_units``, citations and
    references are looked up by key.
    """
    asked = asked_about(queries)
    order = Window.partitionBy("qid").orderBy("dist", "faiss_id")
    near = stored(_near(index, asked, top_k).where(_bit(ACTIVE)).withColumn("seed_rank", F.row_number().over(order)).drop("raw_rank"))
    matches = sum((_bit(b).cast("int") for b in (JO, HANG, MOK)), F.lit(0))
    by_bits = _bit(EXACT)
    if strict:
        by_bits = (matches >= 2) & (_bit(NO_JO) | _bit(JO) if require_jo else F.lit(True))
    near = near.select(
        "qid", "mst", "faiss_id", F.col("dist").alias("distance"), "seed_rank", F.lit(0).alias("stage"), matches.alias("matches"),
        F.lit(True).alias("active"), by_bits.alias("is_promoted"), _bit(IS_ANNEX).alias("annex"),
    )
    narrow = index.drop("v")
    if strict:
        cited = strict_pairs(narrow, asked.drop("q"))
        if require_jo:
            cited = cited.where(X.filled(F.col("c.jo")).isNull() | (F.col("own") == F.col("c.jo")))
    else:
        cited = exact_pairs(narrow, asked.drop("q"))
    inject = stored(
        cited.select("qid", "mst", "faiss_id").join(near.where("is_promoted").select("qid", "faiss_id"), ["qid", "faiss_id"], "left_anti")
    ).select(
        "qid", "mst", "faiss_id", F.lit(FAR).alias("distance"), F.lit(0).alias("seed_rank"), F.lit(1).alias("stage"), F.lit(3).alias("matches"),
        F.lit(True).alias("active"), F.lit(True).alias("is_promoted"), F.lit(True).alias("annex"),
    )
    found = near.unionByName(inject)
    refer = narrow.where(F.size("annex_refs") > 0)
    refs = (
        found.where(F.col("seed_rank") <= max(10, 2 * top_k))
        .select("qid", "mst", "faiss_id")
        .join(refer.select("mst", "faiss_id", "annex_refs"), ["mst", "faiss_id"])
        .select("qid", "mst", F.explode("annex_refs").alias("annex_no"))
        .distinct()
    )
    refs = stored(refs)
    written = F.nullif(F.regexp_extract(X.strip(F.col("jo")), r"^제(\d+(?:의\d+)?)조$", 1), F.lit(""))
    fallback = (
        pairs_by_key(refer.select("mst", "own", "jo", "annex_refs"), asked.select("qid", "mst", "c"), F.array("own", written), F.array(X.filled(F.col("c.jo"))))
        .select("qid", "mst", F.explode("annex_refs").alias("annex_no"))
        .distinct()
        .join(refs.select("qid").distinct(), "qid", "left_anti")
    )
    annexes = narrow.where(F.col("level").isin(*U.ANNEX) & F.col("annex_no").isNotNull())
    told = asked.select("qid", "until", "c")
    wanted = (
        refs.unionByName(fallback)
        .join(annexes, ["mst", "annex_no"])
        .join(F.broadcast(told) if told.count() <= STATED else told, "qid")
        .select("qid", "mst", "faiss_id", U.match_count(*_cite()).alias("t_matches"), (F.col("since") <= F.col("until")).alias("t_active"))
    )
    held = found.where("annex").join(wanted, ["qid", "mst", "faiss_id"], "full_outer")
    new = F.col("stage").isNull()
    held = held.where(~new | F.col("t_active")).select(
        "qid", "mst", "faiss_id", F.coalesce("distance", F.lit(FAR)).alias("distance"), F.coalesce("seed_rank", F.lit(0)).alias("seed_rank"),
        F.coalesce("stage", F.lit(2)).alias("stage"), F.coalesce("matches", "t_matches").alias("matches"),
        F.coalesce("active", "t_active").alias("active"), F.coalesce("is_promoted", F.lit(False)).alias("is_promoted"),
        F.col("t_active").isNotNull().alias("is_target"),
    )
    return held.unionByName(near.where("not annex").drop("annex").withColumn("is_target", F.lit(False)))


def ranked(found: DataFrame, strict: bool = False) -> DataFrame:
    """Candidates with priority and place (``rk``) in the answer to their question."""
    by_match = F.when(F.col("is_promoted"), 3)
    if not strict:
        by_match = by_match.when((F.col("matches") >= 1) & F.col("active"), 1)
    priority = (
        by_match.otherwise(0)
        + F.when(F.col("is_target"), 3).otherwise(0)
        + F.when(F.col("stage") == 2, 1).otherwise(0)
    )
    order = Window.partitionBy("qid").orderBy(F.desc("priority"), "distance", "stage", "faiss_id")
    return found.withColumn("priority", priority).withColumn("rk", F.row_number().over(order))


def with_guarantee(answers: DataFrame, top_k: int) -> DataFrame:
    """The first ``top_k``; if none is a target, the best target takes the last place."""
    whole = Window.partitionBy("qid")
    marks = answers.withColumns(
        {
            "has": F.max((F.col("is_target") & (F.col("rk") <= top_k)).cast("int")).over(whole) == 1,
            "best": F.min(F.when(F.col("is_target") & (F.col("rk") > top_k), F.col("rk"))).over(whole),
        }
    )
    swap = ~F.col("has") & F.col("best").isNotNull()
    kept = marks.where((F.col("rk") < top_k) | F.when(swap, F.col("rk") == F.col("best")).otherwise(F.col("rk") == top_k))
    place = F.row_number().over(Window.partitionBy("qid").orderBy("rk"))
    return kept.withColumn("rank", place).drop("has", "best")


HIT = ("faiss_id", "distance", "level", "annex_no", "jo", "hang", "hang_norm", "mok", "mok_norm", "title", "text", "path", "display_path_norm")


def best_answers(index: DataFrame, queries: DataFrame, top_k: int = 10, strict: bool = False, require_jo: bool = False) -> DataFrame:
    """qid, rank, mst, faiss_id, distance of the answers to all questions."""
    found = candidates(index, queries, top_k, strict, require_jo)
    return with_guarantee(ranked(found, strict), top_k).select("qid", "rank", "mst", "faiss_id", "distance")


def search(units: DataFrame, queries: DataFrame, top_k: int = 10, strict: bool = False, require_jo: bool = False) -> DataFrame:
    """qid, rank and the columns of ``HIT``: answers to all questions.

    ``units`` are normalised and carry ``faiss_id``; ``queries`` (qid, mst,
    query, as_of) are a stated query set.  ``top_k`` must be 1 or more.
    """
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    best = best_answers(indexed(units), queries, top_k, strict, require_jo)
    shown = units.select("mst", *(c for c in HIT if c != "distance"))
    return best.join(shown, ["mst", "faiss_id"]).select("qid", "rank", *HIT)


def reranked_by_parts(index: DataFrame, queries: DataFrame, top_k: int = 10) -> DataFrame:
    """qid, rank, mst, faiss_id, score, shown by the other weighting: 2 for the article, 1 each for paragraph and item.

    Up to 200 leniently matching units (in id order) join the neighbours.  The
    ``index`` has the columns of ``_SHOWN`` too.
    """
    asked = asked_about(queries)
    near = stored(_near(index, asked, top_k).select("qid", "mst", "faiss_id", F.col("dist").alias("distance")))
    narrow = index.select("mst", "faiss_id", "jo", "jo_norm", "hang_norm", "mok_norm", *_SHOWN)
    told = asked.select("qid", "mst", "c")
    hits = (
        lenient_pairs(narrow, told)
        .select("qid", "mst", "faiss_id")
        .withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy("faiss_id")))
        .where("n <= 200")
        .drop("n")
        .join(near.select("qid", "faiss_id"), ["qid", "faiss_id"], "left_anti")
        .withColumn("distance", F.lit(float("inf")))
    )
    path = F.coalesce(X.filled(F.col("display_path_norm")), F.col("path"), F.lit(""))
    no = F.lit(False)
    by_jo = X.filled(F.col("c.jo")).isNotNull() & (
        F.coalesce(F.col("jo") == F.col("c.jo"), no)
        | F.coalesce(F.col("jo_norm") == F.col("c.jo"), no)
        | F.contains(path, F.concat(F.lit("제"), F.col("c.jo"), F.lit("조")))
    )
    score = (
        F.when(by_jo, 2).otherwise(0)
        + F.coalesce(F.col("hang_norm") == F.col("c.hang"), no).cast("int")
        + F.coalesce(F.col("mok_norm") == F.col("c.mok"), no).cast("int")
    )
    told = told.drop("mst")
    both = near.unionByName(hits.select(*near.columns)).join(narrow, ["mst", "faiss_id"])
    both = both.join(F.broadcast(told) if told.count() <= STATED else told, "qid")
    both = both.select("qid", "mst", "faiss_id", "distance", score.alias("score"), F.coalesce("display_path_norm", "path").alias("shown"))
    place = Window.partitionBy("qid").orderBy(F.desc("score"), "distance", "faiss_id")
    return both.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top_k).drop("distance")
