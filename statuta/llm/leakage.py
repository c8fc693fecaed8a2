"""Passages of held-out test items inside a training corpus.

Every sentence of the items' passages is searched in every document.  Both are
reduced to letters and digits.  Windows of the items and of the documents are
embedded by CGK random walks, which turn edit distance into Hamming distance;
positions of the embedded strings are sampled, and windows that agree on all
positions of one sample are candidates.  Several walks and samples are drawn
(bit-sampling LSH), enough to expect a recall of ``RECALL`` for sentences with
an altered word in each window.  The items have a window at each character, the documents at every
``STRIDE``-th, so each sentence has many chances.  Candidates are verified
exactly: a bit-parallel edit-distance search of the whole sentence around the
place of the match.

Sentences too short for enough windows of a walk are searched exactly: cut into
one piece more than they may have edits, one piece of any altered copy stands
unaltered (pigeonhole), so no copy is lost.

The items are a stated query set.  They are searched in blocks of at most
``BLOCK`` sentences, so what the driver holds and broadcasts at a time is
bounded; documents are read in one narrow pass for each block, and never
shuffled.  A sentence that unlike passages share is a standing phrase, however
often documents use it.  One that a single passage has is a standing phrase if
many documents use it (``STANDING``, in ``STANDING_LEAST`` surroundings at least)
and hardly any of them its neighbours of the passage.  A standing phrase is no
evidence, except in a document that holds a neighbour too.  ``standing`` lists
them with the reason.

Defined results: null and empty texts or passages leak nothing; a sentence of
fewer than ``LEAST`` letters and digits is no evidence; an item given twice is
reported under each of its ids; a document given twice likewise.
"""

from __future__ import annotations

import html
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.session import durable, spread

#: Greatest edit distance of a leaked sentence, as a share of its length.  Two
#: long words that change places take more than a fifth of a short sentence.
ALTERED = 0.23
#: A sentence of one passage is used by many documents from this share of them
#: on, in at least ``STANDING_LEAST`` different surroundings ...
STANDING, STANDING_LEAST = 0.004, 20
#: ... unless this share of the documents holds a neighbouring sentence as well.
SUPPORTED = 0.2
#: Walk lengths, longest first.  A sentence takes the first of which it has
#: enough windows; the rest is cut into pieces and searched exactly.
WALKS = (32, 16)
LEAST = 8
#: Walks, samples of each, positions in a sample, and the distance between a
#: document's windows.
N_WALKS, N_SAMPLES, BITS, STRIDE = 3, 4, 9, 4
#: Share of a window's positions that an altered word changes, and windows of a
#: leaked sentence that hold at most one such word; together they give
#: ``RECALL``, the least expected recall of the candidate search.
CHANGED, WINDOWS = 0.2, 4
RECALL = 1 - (1 - (1 - CHANGED) ** BITS) ** (N_WALKS * N_SAMPLES * WINDOWS)
#: Sentences searched at a time.
BLOCK = 20_000

# Mark-up, special-token strings, addresses, invisible marks, phrase signs and
# long runs of one character, none of which belong to a sentence.
_MARKUP = regex.compile(
    r"</?[A-Za-z][^<>\n]{0,60}>|<\|[^|<>\n]{1,40}\|>|(?:https?://|/)[A-Za-z0-9_./?&=%#+~-]{6,}"
    r"|\p{Cf}|[\uFDF0-\uFDFD]|(.)\1{7,}"
)
_NOISE = regex.compile(r"[^\p{L}\p{N}]+")
_ENDS = regex.compile(r"(?<=[.!?。！？．])\s+|(?<=[。！？．])|[\n\r]+")
_ALPHABET = 4096
_PAD = 2 * WALKS[0]


def reduced(text: str) -> str:
    """Letters and digits of a text, lower case, compatibility forms undone."""
    if "&" in text:
        text = html.unescape(text)
    return _NOISE.sub("", unicodedata.normalize("NFKC", _MARKUP.sub("", text)).lower())


def passage_sentences(passage: str | None) -> list[str]:
    """Reduced sentences of a passage, without those too short to be evidence."""
    found = (reduced(part) for part in _ENDS.split(passage or ""))
    return [s for s in found if len(s) >= LEAST]


class Walks:
    """The random walks and samples, the same on every executor."""

    def __init__(self, seed: int = 20_240_501):
        self.steps, self.samples, self.mix = {}, {}, {}
        for length in WALKS:
            rng = np.random.default_rng(seed + length)
            self.steps[length] = rng.integers(0, 2, (N_WALKS, length, _ALPHABET), dtype=np.uint8)
            self.samples[length] = [
                [np.sort(rng.choice(length, BITS, replace=False)) for _ in range(N_SAMPLES)] for _ in range(N_WALKS)
            ]
            self.mix[length] = rng.integers(1, 2**63, (N_WALKS, N_SAMPLES, BITS), dtype=np.uint64) | np.uint64(1)

    def hashes(self, codes: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of every sample (rows) at every start (columns), and how far the walks went."""
        out = np.zeros((N_WALKS * N_SAMPLES, len(starts)), np.uint64)
        reach = np.zeros(len(starts), np.int64)
        for w in range(N_WALKS):
            at = starts.astype(np.int64)
            wanted = defaultdict(list)
            for s, positions in enumerate(self.samples[length][w]):
                for b, position in enumerate(positions):
                    wanted[int(position)].append((w * N_SAMPLES + s, self.mix[length][w, s, b]))
            last = max(wanted)
            for step in range(last + 1):
                seen = codes[at]
                for row, factor in wanted.get(step, ()):
                    mixed = out[row] ^ (seen.astype(np.uint64) + np.uint64(step + 1))
                    out[row] = (mixed ^ (mixed >> np.uint64(31))) * factor
                if step < last:
                    at += self.steps[length][w, step][seen & (_ALPHABET - 1)]
            np.maximum(reach, at, out=reach)
        return out, reach


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with room after each, and where each begins."""
    room = "\0" * _PAD
    joined = "".join(t + room for t in texts)
    lengths = np.fromiter((len(t) + _PAD for t in texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if texts else np.zeros(0, np.int64)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), starts


class Index:
    """Sorted keys of the windows of all sentences, by walk length."""

    def __init__(self, sentences: list[str]):
        self.sentences, self.walks = sentences, Walks()
        self.bags = [Counter(s) for s in sentences]
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        left = np.arange(len(sentences))
        for length in WALKS:
            if not len(left):
                break
            codes, begins = _codes([sentences[k] for k in left])
            sizes = np.array([len(sentences[k]) for k in left])
            which = np.repeat(np.arange(len(left)), sizes)
            offset = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keys, reach = self.walks.hashes(codes, begins[which] + offset, length)
            inside = reach < begins[which] + sizes[which]
            # the first windows of a sentence must all be inside, or a document's may miss them
            enough = np.bincount(which[inside], minlength=len(left)) >= 2 * STRIDE
            inside &= enough[which]
            if inside.any():
                rows = []
                for row in keys[:, inside]:
                    order = np.argsort(row, kind="stable")
                    rows.append((row[order], left[which[inside]][order], offset[inside][order]))
                self.tables[length] = rows
            left = left[~enough]
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        pieces = defaultdict(list)
        for k in left:
            for at, end in pieces_of(len(sentences[k])):
                pieces[end - at].append((sentences[k][at:end], k, at))
        for size, rows in pieces.items():
            codes, begins = _codes([r[0] for r in rows])
            keys = _grams(codes, size)[begins]
            order = np.argsort(keys, kind="stable")
            self.pieces[size] = keys[order], np.array([r[1] for r in rows])[order], np.array([r[2] for r in rows])[order]

    def candidates(self, texts: list[str]) -> Iterator[tuple[int, int, int]]:
        """(text, sentence, place where the sentence would begin), each once."""
        codes, begins = _codes(texts)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        found = []
        for length, tables in self.tables.items():
            counts = (sizes + STRIDE - 1) // STRIDE
            which = np.repeat(np.arange(len(texts)), counts)
            offset = (np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
            keys, _ = self.walks.hashes(codes, begins[which] + offset, length)
            for row, (known, ids, shift) in zip(keys, tables):
                found += _meet(known, ids, shift, row, which, offset)
        if self.pieces:
            which = np.repeat(np.arange(len(texts)), sizes)
            offset = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            for size, (known, ids, shift) in self.pieces.items():
                found += _meet(known, ids, shift, _grams(codes, size)[begins[which] + offset], which, offset)
        if found:
            for text, sentence, place in np.unique(np.concatenate(found), axis=0):
                yield int(text), int(sentence), int(place) * 8 + 4


def pieces_of(size: int) -> list[tuple[int, int]]:
    """Spans that cut a sentence of ``size`` characters into one piece more than it may have edits."""
    n = int(ALTERED * size) + 1
    return [(size * k // n, size * (k + 1) // n) for k in range(n)]


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A key of the ``size`` characters from each position on."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(size):
        ahead = np.zeros(len(codes), np.uint64)
        ahead[: len(codes) - k] = codes[k:]
        mixed = (out ^ (ahead + np.uint64(k + 1))) * np.uint64(0x9E3779B97F4A7C15)
        out = mixed ^ (mixed >> np.uint64(31))
    return out


def _meet(known, ids, shift, keys, which, offset) -> list[np.ndarray]:
    """(text, sentence, place) wherever a key of the texts is a known one."""
    low = np.searchsorted(known, keys, "left")
    hit = np.nonzero((low < len(known)) & (known[np.minimum(low, len(known) - 1)] == keys))[0]
    if not len(hit):
        return []
    times = np.searchsorted(known, keys[hit], "right") - low[hit]
    source = np.repeat(hit, times)
    target = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[hit], times)
    # places within a few characters of each other are one place
    return [np.stack([which[source], ids[target], (offset[source] - shift[target]) // 8], axis=1)]


def edit_search(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and where that
    part ends; Myers' bit-parallel algorithm with the pattern in one integer."""
    size = len(pattern)
    masks: dict[str, int] = {}
    for k, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << k
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, end = full, 0, size, size, 0
    for k, char in enumerate(text, 1):
        equal = masks.get(char, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if score < best:
            best, end = score, k
    return best, end


def matches(texts: list[str], index: Index) -> list[tuple[int, int, float, str]]:
    """(text, sentence, distance as a share, surroundings) of verified matches,
    the best place for each text and sentence."""
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for t, k, place in index.candidates(texts):
        known = best.get((t, k))
        if known is not None and known[0] == 0:
            continue
        sentence, text = index.sentences[k], texts[t]
        slack = max(12, len(sentence) // 4)
        start = max(0, place - slack)
        window = text[start : place + len(sentence) + slack]
        # each character the window lacks takes an edit, so this loses nothing
        if (index.bags[k] - Counter(window)).total() > ALTERED * len(sentence):
            continue
        distance, end = edit_search(sentence, window)
        share = distance / len(sentence)
        if share <= ALTERED and (known is None or share < known[0]):
            stop = start + end
            begin = max(0, stop - len(sentence))
            best[t, k] = share, text[max(0, begin - 12) : max(0, begin - 2)] + "|" + text[stop + 2 : stop + 12]
    return [(t, k, share, around) for (t, k), (share, around) in best.items()]


_MATCH = "sentence long, distance double, around string"
_PASSAGE = "passage long, sentence long, body string, size int, near array<long>"


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def item_sentences(items: DataFrame, item_col: str = "item_id", passage_col: str = "passage") -> DataFrame:
    """item id, passage (a hash), sentence (a hash), body, size (sentences of the
    passage), near (its neighbours): each sentence of each passage once."""
    schema = T.StructType([items.schema[item_col], *T._parse_datatype_string(_PASSAGE).fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                bodies = list(dict.fromkeys(passage_sentences(text)))
                keys = [_key(b) for b in bodies]
                whole = _key("\n".join(bodies))
                take += [k] * len(keys)
                rows += [(whole, key, bodies[at], len(keys), keys[max(0, at - 1) : at] + keys[at + 1 : at + 2]) for at, key in enumerate(keys)]
            columns = list(zip(*rows)) if rows else [()] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(take, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))], names=names
            )

    return items.select(item_col, passage_col).mapInArrow(run, schema)


def sentence_matches(docs: DataFrame, sentences: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, sentence, distance, around: where each sentence (rows of sentence, body) stands."""
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(_MATCH).fields])
    names = schema.fieldNames()
    rows = spread(docs.select(id_col, text_col).where(F.col(text_col).isNotNull()), id_col)

    def found_of(block: list) -> DataFrame:
        """The matches of one block of sentences, written before the next one is read."""
        keys = np.array([r["sentence"] for r in block], np.int64)
        shared = docs.sparkSession.sparkContext.broadcast((Index([r["body"] for r in block]), keys))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, keys = shared.value
            for whole in batches:
                for first in range(0, whole.num_rows, 256):
                    batch = whole.slice(first, 256)
                    found = matches([reduced(t) for t in batch.column(1).to_pylist()], index)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([m[0] for m in found], pa.int64())),
                            pa.array([keys[m[1]] for m in found], pa.int64()),
                            pa.array([m[2] for m in found], pa.float64()),
                            pa.array([m[3] for m in found], pa.string()),
                        ],
                        names=names,
                    )

        result = durable(rows.mapInArrow(run, schema))
        shared.unpersist()
        return result

    result, block = None, []
    for row in sentences.select("sentence", "body").distinct().orderBy("sentence").toLocalIterator():
        block.append(row)
        if len(block) == BLOCK:
            part, block = found_of(block), []
            result = part if result is None else result.unionByName(part)
    if block or result is None:
        part = found_of(block)
        result = part if result is None else result.unionByName(part)
    return result


def _hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, passage_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc id, item id, sentence, distance, supported, shared; the standing phrases)."""
    parts = durable(item_sentences(items, item_col, passage_col))
    found = sentence_matches(docs, parts, id_col, text_col)
    shared = parts.groupBy("sentence").agg((F.count_distinct("passage") > 1).alias("shared"))
    # neighbours that other passages share are no evidence
    near = (
        parts.select("passage", "sentence", F.explode("near").alias("at")).distinct()
        .join(shared.where("not shared").select(F.col("sentence").alias("at")), "at")
        .groupBy("passage", "sentence").agg(F.collect_set("at").alias("beside"))
    )
    owned = (
        parts.join(shared, "sentence").join(near, ["passage", "sentence"], "left")
        .select("sentence", item_col, "shared", F.coalesce("beside", F.array().cast("array<long>")).alias("beside"),
                (~F.col("shared") & (F.col("size") == 1)).alias("whole"))
    )
    here = found.groupBy(id_col).agg(F.collect_set("sentence").alias("here"))
    hits = (
        found.join(owned, "sentence").join(here, id_col)
        .withColumn("supported", F.col("whole") | F.arrays_overlap("beside", "here"))
    )
    phrases = (
        hits.groupBy("sentence")
        .agg(
            F.count_distinct("around").alias("places"), F.count_distinct(id_col).alias("documents"),
            F.avg(F.col("supported").cast("int")).alias("share"), F.max("shared").alias("shared"),
        )
        .join(F.broadcast(docs.agg(F.count(F.lit(1)).alias("docs"))), F.lit(True))
    )
    many = (F.col("places") >= STANDING_LEAST) & (F.col("documents") > STANDING * F.col("docs")) & (F.col("share") < SUPPORTED)
    reason = F.when(F.col("shared"), "shared by unlike passages").when(many, "used by many documents without its neighbours")
    return hits, phrases.withColumn("reason", reason).where("reason is not null").select("sentence", "documents", "reason")


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    passage_col: str = "passage",
) -> DataFrame:
    """doc id, item id, sentences (how many leaked), distance (of the closest one)."""
    hits, phrases = _hits(docs, items, id_col, text_col, item_col, passage_col)
    return (
        hits.join(phrases, "sentence", "left")
        .where("reason is null or supported")
        .groupBy(id_col, item_col)
        .agg(F.count(F.lit(1)).alias("sentences"), F.round(F.min("distance"), 4).alias("distance"))
    )


def leak_report(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    passage_col: str = "passage",
) -> DataFrame:
    """item id, sentence, documents (where it counts), passed_over (documents where it
    doesn't), reason (why not): every sentence of every item that stands in any document."""
    hits, phrases = _hits(docs, items, id_col, text_col, item_col, passage_col)
    counted = F.col("reason").isNull() | F.col("supported")
    bodies = item_sentences(items, item_col, passage_col).select("sentence", "body").distinct()
    return (
        hits.join(phrases.drop("documents"), "sentence", "left")
        .groupBy(item_col, "sentence")
        .agg(
            F.count_distinct(F.when(counted, F.col(id_col))).alias("documents"),
            F.count_distinct(F.when(~counted, F.col(id_col))).alias("passed_over"),
            F.max("reason").alias("reason"),
        )
        .join(bodies, "sentence")
        .select(item_col, F.col("body").alias("sentence"), "documents", "passed_over", "reason")
    )
