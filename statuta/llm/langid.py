"""Languages of documents and of the segments of mixed ones.

For each language an interpolated Kneser-Ney character model is trained on the
labelled samples.  The n-grams of all models lie together in one sorted array
of 64-bit hashes per order, with a column of discounted probabilities and of
back-off weights for each language, so a batch of texts is scored for all
languages by a few vectorised searches.  A sentence gets the language of the
lowest length-normalised cross-entropy.  Confidence is the softmax of the
entropy gaps at a temperature calibrated on held-out samples.

Rejection is calibrated on what must be refused: for a language of an alphabet,
the samples of the other languages of that alphabet and its own held-out samples
with their letters shuffled.  The least entropy that these reach is the limit.  A
sentence below it whose entropy is still above that of held-out samples is kept
only if at least ``KNOWN`` of its words stand in the language's samples, as no
foreign language's do.  For other scripts the limit is the entropy of held-out
samples of which every second letter is foreign.

Below the character models lies a model of scripts (kana, Han, Hangul, Latin
with and without marks ...), which spreads its mass over the script's
characters: unseen characters of a known script cost the languages that write
in it alike, and the absence of a script counts too.

Training uses at most ``max_samples`` labelled rows of each language (a documented
bound, far above the table's fixed size; which ones, a hash decides); every
document and every sentence is scored.

Defined results: null, blank and wordless texts have no segments and no
language; a document with words but without an accepted full sentence has the
language of its longest segment (null if that is rejected) and ``complete`` false;
texts of any length are scored sentence by sentence.
"""

from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.session import spread

#: Longest n-gram, and how many labelled rows of a language are used for training.
ORDER, MAX_SAMPLES = 4, 4_000
#: Part of each language's samples that calibrates confidence and rejection.
HELD_OUT = 5
#: Standard deviations above the mean of held-out samples that count as usual.
SLACK = 4.0
#: Least share of known words in a sentence of unusual entropy.
KNOWN = 0.2
#: Pseudo-count of a script that a language's samples don't use.
UNSEEN = 0.01
#: Sentences of fewer letters (a Han, kana or Hangul character counts as three) are no full sentences.
LEAST_LETTERS = 12

_SCRIPTS = [
    ("hangul", regex.compile(r"\p{Hangul}")),
    ("kana", regex.compile(r"[\p{Hiragana}\p{Katakana}ー々]")),
    ("han", regex.compile(r"\p{Han}")),
    ("latin", regex.compile(r"[a-z]")),
    ("marked", regex.compile(r"\p{Latin}")),
    ("cyrillic", regex.compile(r"\p{Cyrillic}")),
    ("letter", regex.compile(r"\p{L}")),
]
# Rough numbers of characters that a script spreads its probability over.
_SIZES = {"hangul": 2500, "kana": 170, "han": 6000, "latin": 26, "marked": 140, "cyrillic": 66, "letter": 20000, "space": 1}
_SCRIPT_NAMES = list(_SIZES)
# Fixed value: scripts that a language may be written in beside those its
# samples show, with the share of letters to allow for.
ALSO_WRITTEN_IN = {"ko": {"han": 0.1}}

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
# A sentence ends after its mark and closing signs: before white space or a
# sign, or, after a letter of a dense script, before any letter.
_BREAK = regex.compile(
    r"(?<=[.!?…][\'\"”’)\]]?)(?:\s+|(?=[^\s\p{L}\p{N}.!?…\'\"”’)\]]))"
    r"|(?<=[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}][.!?])(?=\p{L})"
    r"|(?<=[。！？．][」』”’）]?)(?![。！？．」』”’）])"
)
_LINE = regex.compile(r"[\n\r\v\f\x1c-\x1e\x85]+")
# A line that goes on: it ends with a letter, a number or a comma, and neither it
# nor the next is a row of a table, a heading or an item of a list.
_OPEN = regex.compile(r"[\p{L}\p{M}\p{N},，、][\t ]*$")
_OWN_LINE = regex.compile(r"[\t ]*(?:[|>*#•·○●□■◇◆▶-]|\d+[.)]|[①-⑳]|제\d+조|\p{L}[.)]\s)")
_END = regex.compile(r"[.!?…。！？．]['\"”’」』）)\]]*\s*$")
# Mark-up, addresses and paths; they are blanked out before anything else.
_TAG = regex.compile(r"<[^<>\n]{1,80}>|(?:https?://|/)[A-Za-z0-9_./?&=%#+~-]{6,}|[\w.+-]+@[\w-]+\.[\w.]+")
# Marks without width, and signs that stand for whole words or phrases.
_IGNORED = regex.compile(r"[\p{Cf}\uFDF0-\uFDFD\u3300-\u3357]")
_LETTERS = regex.compile(r"[\p{L}\p{M}]")
_DENSE = regex.compile(r"[\p{Han}\p{Hangul}\p{Hiragana}\p{Katakana}]")


def plain(text: str) -> str:
    """Letters and single spaces of a text, lower case, compatibility forms undone."""
    text = unicodedata.normalize("NFKC", _IGNORED.sub("", text)).lower()
    return regex.sub(r"[^\p{L}\p{M}]+", " ", text).strip()


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences of a text; lines that break off go on in the next."""
    lines, start = [], 0
    for found in _LINE.finditer(text):
        lines.append((start, found.start()))
        start = found.end()
    lines.append((start, len(text)))
    blocks: list[tuple[int, int]] = []
    for s, e in lines:
        if blocks and text.count("\n", blocks[-1][1], s) < 2 and _goes_on(text, blocks[-1], (s, e)):
            blocks[-1] = (blocks[-1][0], e)
        else:
            blocks.append((s, e))
    spans = []
    for s, e in blocks:
        for found in _BREAK.finditer(text, s, e):
            if found.start() > s:
                spans.append((s, found.start()))
            s = max(s, found.end())
        if s < e:
            spans.append((s, e))
    return [(s, e) for s, e in spans if not text[s:e].isspace()]


def _goes_on(text: str, before: tuple[int, int], line: tuple[int, int]) -> bool:
    last = text.rfind("\n", *before) + 1 or before[0]
    return bool(_OPEN.search(text, last, before[1])) and not (
        _OWN_LINE.match(text, last, before[1]) or _OWN_LINE.match(text, *line) or line[0] == line[1]
    )


def weight(text: str) -> int:
    """Letters of a text; dense scripts count three a character."""
    return len(_LETTERS.findall(text)) + 2 * len(_DENSE.findall(text))


def _script(char: str) -> str:
    if char == " ":
        return "space"
    return next((name for name, pattern in _SCRIPTS if pattern.match(char)), "letter")


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between its boundary marks, and the text of each."""
    joined = "".join("\x02" * (ORDER - 1) + t + "\x03" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(t) + ORDER for t in texts), np.int64, len(texts))
    return codes, np.repeat(np.arange(len(texts)), lengths)


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n-gram that ends at each position."""
    out = [(codes + np.uint64(1)) * _MULTIPLY]
    for _ in range(1, order):
        before = np.empty_like(codes)
        before[0] = 0
        before[1:] = out[-1][:-1]
        mixed = (before ^ (before >> np.uint64(29))) * _MULTIPLY
        out.append((mixed + codes + np.uint64(1)) * _MULTIPLY)
    return out


class Models:
    """The Kneser-Ney models of all languages, ready for scoring."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.temperature, self.limits = 1.0, np.full(len(self.languages), np.inf)
        self.usual = np.full(len(self.languages), np.inf)
        self.words = [frozenset(w for t in samples[name] for w in plain(t).split()) for name in self.languages]
        counts = [self._counts([plain(t) for t in samples[name]]) for name in self.languages]
        chars = sorted({g[-1] for c in counts for g in c[1]})
        self._scripts(counts)
        self._tables(counts, chars)

    @staticmethod
    def _counts(texts: list[str]) -> list[Counter]:
        """Counts by order: raw at the highest, continuation counts below."""
        raw = Counter()
        for text in texts:
            padded = "\x02" * (ORDER - 1) + text + "\x03"
            raw.update(padded[i : i + ORDER] for i in range(len(padded) - ORDER + 1))
        orders = [Counter() for _ in range(ORDER + 1)]
        orders[ORDER] = raw
        for n in range(ORDER - 1, 0, -1):
            orders[n] = Counter(g[1:] for g in orders[n + 1])
        return orders

    def _scripts(self, counts: list[list[Counter]]) -> None:
        table = np.zeros((len(_SCRIPT_NAMES), len(counts)))
        for k, orders in enumerate(counts):
            for gram, n in orders[ORDER].items():
                if gram[-1] != "\x03":
                    table[_SCRIPT_NAMES.index(_script(gram[-1])), k] += n
        for k, name in enumerate(self.languages):
            for script, share in ALSO_WRITTEN_IN.get(name, {}).items():
                table[_SCRIPT_NAMES.index(script), k] += share * table[:, k].sum()
        table = (table + UNSEEN) / (table + UNSEEN).sum(axis=0)
        self.base = table / np.array([_SIZES[s] for s in _SCRIPT_NAMES])[:, None]

    def _tables(self, counts: list[list[Counter]], chars: list[str]) -> None:
        width = len(counts)
        self.grams, self.alpha, self.gamma = [], [], []
        for n in range(1, ORDER + 1):
            alpha: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(width))
            gamma: dict[str, np.ndarray] = defaultdict(lambda: np.ones(width))
            for k, orders in enumerate(counts):
                spectrum = Counter(orders[n].values())
                discount = spectrum[1] / max(1, spectrum[1] + 2 * spectrum[2]) or 0.5
                discount = min(max(discount, 0.1), 0.9)
                total, kinds = Counter(), Counter()
                for gram, c in orders[n].items():
                    total[gram[:-1]] += c
                    kinds[gram[:-1]] += 1
                for gram, c in orders[n].items():
                    alpha[gram][k] = (c - discount) / total[gram[:-1]]
                for context, c in total.items():
                    gamma[context][k] = discount * kinds[context] / c
            self.grams.append(self._sorted(alpha, n))
            self.gamma.append(self._sorted(gamma, n - 1) if n > 1 else gamma[""])

    @staticmethod
    def _sorted(table: dict[str, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        keys = list(table)
        codes = np.frombuffer("".join(keys).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        # n-grams are hashed one after another, so only each one's last position counts
        hashed = np.zeros(len(keys), np.uint64)
        for j in range(n):
            c = codes[j::n]
            hashed = (c + np.uint64(1)) * _MULTIPLY if j == 0 else (
                ((hashed ^ (hashed >> np.uint64(29))) * _MULTIPLY + c + np.uint64(1)) * _MULTIPLY
            )
        order = np.argsort(hashed)
        return hashed[order], np.array([table[k] for k in keys], np.float32)[order]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
        hashed, values = table
        at = np.minimum(np.searchsorted(hashed, keys), len(hashed) - 1)
        found = values[at]
        found[hashed[at] != keys] = missing
        return found

    def _bases(self, codes: np.ndarray) -> np.ndarray:
        chars, inverse = np.unique(codes, return_inverse=True)
        rows = [
            self.base[_SCRIPT_NAMES.index(_script(chr(int(c))))] if c != 3 else np.full(len(self.languages), 0.02)
            for c in chars
        ]
        return np.array(rows, np.float32)[inverse]

    def entropies(self, texts: list[str], block: int = 400_000) -> np.ndarray:
        """Cross-entropy in nats a character, one row a text, one column a language."""
        out = np.zeros((len(texts), len(self.languages)))
        start = 0
        while start < len(texts):
            end, room = start, 0
            while end < len(texts) and (end == start or room + len(texts[end]) < block):
                room += len(texts[end]) + ORDER
                end += 1
            out[start:end] = self._block(texts[start:end])
            start = end
        return out

    def _block(self, texts: list[str]) -> np.ndarray:
        codes, owner = _codes(texts)
        hashes = _hashes(codes, ORDER)
        # n-grams never reach over a boundary: the marks before each text are ORDER - 1 long
        scored = codes != 2
        p = self._find(self.grams[0], hashes[0][scored], 0.0) + self.gamma[0].astype(np.float32) * self._bases(codes[scored])
        where = np.nonzero(scored)[0]
        for n in range(2, ORDER + 1):
            seen = self._find(self.grams[n - 1], hashes[n - 1][where], 0.0)
            back = self._find(self.gamma[n - 1], hashes[n - 2][where - 1], 1.0)
            p = seen + back * p
        logs = -np.log(p)
        owners = owner[scored]
        sums = np.stack([np.bincount(owners, logs[:, k], len(texts)) for k in range(logs.shape[1])], axis=1)
        return sums / np.bincount(owners, minlength=len(texts))[:, None]

    def classify(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, confidence, and whether it is accepted."""
        if not texts:
            return np.zeros(0, int), np.zeros(0), np.zeros(0, bool)
        entropy = self.entropies(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(texts)), best]
        lengths = np.fromiter((len(t) for t in texts), float, len(texts))
        gaps = (entropy - lowest[:, None]) * np.sqrt(np.maximum(lengths, 1.0))[:, None]
        confidence = 1 / np.exp(-gaps / self.temperature).sum(axis=1)
        accepted = lowest <= self.limits[best]
        for k in np.nonzero(accepted & (lowest > self.usual[best]))[0]:
            words = texts[k].split()
            accepted[k] = sum(w in self.words[best[k]] for w in words) >= KNOWN * len(words)
        return best, confidence, accepted


def _alphabet(texts: list[str]) -> str | None:
    """The alphabet that most letters of the texts belong to; None for other scripts."""
    counts = Counter(_script(c) for t in texts for c in plain(t) if c != " ")
    counts["latin"] += counts.pop("marked", 0)
    most = max(counts, key=counts.get, default=None)
    return most if most in ("latin", "cyrillic") else None


def _foreign(text: str) -> str:
    """``text`` with every second letter replaced by one of a script no language uses."""
    return "".join("\u10d0" if k % 2 and c != " " else c for k, c in enumerate(text))


def train(samples: dict[str, list[str]]) -> Models:
    """Models of all samples, calibrated on folds held out in turn."""
    names = sorted(samples)
    entropy, own, shuffled = ({name: [] for name in names} for _ in range(3))
    gaps, right = [], []
    rng = random.Random(HELD_OUT)
    for fold in range(HELD_OUT):
        kept = {k: [t for i, t in enumerate(v) if i % HELD_OUT != fold] or v for k, v in samples.items()}
        out = [(k, t) for k, v in samples.items() for i, t in enumerate(v) if i % HELD_OUT == fold]
        if not out:
            continue
        models = Models(kept)
        texts = [plain(t) for _, t in out]
        scores = models.entropies(texts)
        foreign = models.entropies([_foreign(t) for t in texts])
        mixed = models.entropies(["".join(rng.sample(t, len(t))) for t in texts])
        for (name, _), one, two, three in zip(out, foreign, scores, mixed):
            for table, row in ((entropy, one), (own, two), (shuffled, three)):
                table[name].append(row[names.index(name)])
        for (name, _), text, row in zip(out, texts, scores):
            gaps.append((row - row.min()) * math.sqrt(max(1, len(text))))
            right.append(names.index(name))
    models = Models(samples)
    if gaps:
        table, target = np.array(gaps), np.array(right)
        grid = np.geomspace(0.05, 20, 60)
        # one wrong sample at the smallest gap keeps the temperature finite
        losses = [
            (gap := table / t) is not None
            and np.mean(gap[np.arange(len(target)), target] + np.log(np.exp(-gap).sum(axis=1)))
            + np.log1p(np.exp(-np.sort(np.partition(gap, 1, axis=1)[:, 1])[0])) / len(target)
            for t in grid
        ]
        models.temperature = float(max(grid[int(np.argmin(losses))], 0.5))
    alphabets = {name: _alphabet(samples[name]) for name in names}
    for k, name in enumerate(names):
        if alphabets[name] is None or not own[name]:
            values = entropy[name] or [5.0]
            models.limits[k] = np.mean(values) + SLACK * max(np.std(values), 0.05)
            continue
        other = [plain(t) for n in names if n != name and alphabets[n] == alphabets[name] for t in samples[n]]
        models.usual[k] = np.mean(own[name]) + SLACK * max(np.std(own[name]), 0.05)
        refused = [*(models.entropies(other)[:, k] if other else ()), *shuffled[name]]
        models.limits[k] = max(min(refused), models.usual[k])
    return models


def samples_of(labelled: DataFrame, max_samples: int = MAX_SAMPLES) -> dict[str, list[str]]:
    """Sample texts by language; at most ``max_samples`` rows of each reach the driver."""
    rows = labelled.where("lang is not null and length(trim(text)) > 0")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "sample_id"))
    out: dict[str, list[str]] = defaultdict(list)
    for row in rows.withColumn("place", place).where(F.col("place") <= max_samples).select("lang", "text", "sample_id").collect():
        out[row["lang"]].append((row["sample_id"], row["text"]))
    return {lang: [t for _, t in sorted(found)] for lang, found in sorted(out.items())}


# Codes and names of the languages, as labels write them.
NAMES = {
    "ko": "ko, kor, korean, 한국어, 한글, 국어, 조선어, coréen, koreanisch, tiếng hàn, 韩语, 韓語, 韩国语, 韓国語, 朝鮮語",
    "en": "en, eng, english, 영어, englisch, anglais, tiếng anh, 英語, 英语, 英文, inglés",
    "ja": "ja, jp, jpn, japanese, 日本語, 日本语, 일본어, 일어, japanisch, japonais, 日语, 日語, 日文, tiếng nhật",
    "zh": "zh, cn, chi, zho, cmn, yue, chinese, mandarin, 中文, 汉语, 漢語, 简体中文, 繁體中文, 繁体中文, 简体, 繁體, 중국어, chinesisch, chinois, 中国語, 中國語, tiếng trung",
    "vi": "vi, vn, vie, vietnamese, 베트남어, 월남어, vietnamesisch, tiếng việt, việt, 越南语, 越南語, ベトナム語",
    "de": "de, deu, ger, german, 독일어, deutsch, allemand, 德语, 德語, ドイツ語, tiếng đức",
    "fr": "fr, fra, fre, french, 프랑스어, français, französisch",
    "es": "es, spa, spanish, 스페인어, español, spanisch",
    "ru": "ru, rus, russian, 러시아어, русский",
    "pt": "pt, por, portuguese, 포르투갈어, português",
    "it": "it, ita, italian, 이탈리아어, italiano",
    "id": "id, ind, indonesian, 인도네시아어, bahasa indonesia",
    "th": "th, tha, thai, 태국어",
    "ar": "ar, ara, arabic, 아랍어",
}
_BY_NAME = {name: code for code, names in NAMES.items() for name in names.split(", ")}


def label_languages(label: Column) -> Column:
    """The languages that a label names, in codes; empty if it names none.

    The label is read as one name, else as a list of names, else word by word.
    Codes with a script or a country (``zh-Hant``, ``ko_KR``) name the language
    of their first part.
    """
    table = F.create_map(*(F.lit(x) for pair in sorted(_BY_NAME.items()) for x in pair))
    plain_label = F.regexp_replace(F.lower(F.trim(label)), r"[-_](?:[a-z]{4}|[a-z]{2}|\d{3})\b", "")

    def codes(parts: Column) -> Column:
        return F.array_distinct(F.filter(F.transform(parts, lambda w: F.try_element_at(table, F.trim(w))), lambda c: c.isNotNull()))

    # words only where a part is no name as a whole
    def read(part: Column) -> Column:
        whole = F.try_element_at(table, F.trim(part))
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(codes(F.split(part, r"[^\p{L}\p{M}]+")))

    parts = F.split(plain_label, r"[,;/+&|()\[\]]+")
    return F.coalesce(F.array_distinct(F.flatten(F.transform(parts, read))), F.array().cast("array<string>"))


_SEGMENT = "start_pos int, end_pos int, lang string, confidence double, complete boolean"


def segments_of(text: str | None) -> list[tuple[int, int, str, bool]]:
    """(start, end, plain text, is a full sentence) of the sentences with words."""
    out = []
    text = _TAG.sub(lambda m: " " * len(m[0]), text or "")
    for s, e in sentences(text):
        part = text[s:e]
        words = plain(part)
        if words:
            out.append((s, e, words, weight(words) >= LEAST_LETTERS and bool(_END.search(part))))
    return out


def detect_segments(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start_pos, end_pos, lang (null if rejected), confidence, complete: every
    sentence or line with words of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(samples_of(labelled)))
    names = [id_col, "start_pos", "end_pos", "lang", "confidence", "complete"]
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(_SEGMENT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        languages = np.array(models.languages, dtype=object)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                take, rows = [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    found = segments_of(text)
                    take += [k] * len(found)
                    rows += found
                best, confidence, accepted = models.classify([r[2] for r in rows])
                lang = [x if ok else None for x, ok in zip(languages[best], accepted)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(take, pa.int64())),
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array(lang, pa.string()),
                        pa.array(confidence, pa.float64()),
                        pa.array([r[3] for r in rows], pa.bool_()),
                    ],
                    names=names,
                )

    return spread(docs.select(id_col, text_col), id_col).mapInArrow(run, schema)


def document_languages(segments: DataFrame, id_col: str = "doc_id", every: bool = False) -> DataFrame:
    """id, lang, sentences, confidence (mean), complete: languages with a full
    sentence in each document.

    With ``every``, documents without one follow, in the language of their longest
    segment, ``complete`` being false.
    """
    good = F.col("complete") & F.col("lang").isNotNull()
    full = segments.where(good).groupBy(id_col, "lang").agg(
        F.count(F.lit(1)).alias("sentences"), F.round(F.avg("confidence"), 6).alias("confidence"), F.lit(True).alias("complete")
    )
    if not every:
        return full
    size = F.col("end_pos") - F.col("start_pos")
    longest = F.max(F.struct(F.col("lang").isNotNull().alias("known"), size.alias("size"), (-F.col("start_pos")).alias("at"), "lang", "confidence"))
    rest = segments.groupBy(id_col).agg(F.max(good).alias("any"), longest.alias("x")).where("not any")
    return full.unionByName(
        rest.select(
            id_col, "x.lang", F.lit(0).cast("long").alias("sentences"),
            F.round(F.when(F.col("x.known"), F.col("x.confidence") / 2).otherwise(0.0), 6).alias("confidence"), F.lit(False).alias("complete"),
        )
    )


def relabelled(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang, confidence, reason of documents whose label can't stand.

    One row for each language of a document that is ``mixed``, or whose label is
    ``missing`` or ``wrong``.  A label is wrong if it names no or not only the
    text's language.
    """
    found = document_languages(detect_segments(docs, labelled, id_col, text_col), id_col)
    # one row a document: at most as many entries as there are languages
    texts = found.groupBy(id_col).agg(F.collect_list(F.struct("lang", "confidence")).alias("found"))
    named = docs.select(id_col, label_languages(F.col("lang")).alias("named"))
    joined = texts.join(named, id_col)
    reason = (
        F.when(F.size("found") > 1, "mixed")
        .when(F.size("named") == 0, "missing")
        .when(F.col("named") != F.array(F.col("found")[0]["lang"]), "wrong")
    )
    return (
        joined.select(id_col, "found", reason.alias("reason"))
        .where("reason is not null")
        .select(id_col, F.explode("found").alias("x"), "reason")
        .select(id_col, "x.lang", "x.confidence", "reason")
    )
