import math
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from statuta.llm import langid as G
from tests.support import DATA, needs_data

pytestmark = needs_data


@pytest.fixture(scope="module")
def samples():
    frame = pd.read_parquet(f"{DATA}/lang_samples.parquet")
    return {lang: list(rows.text) for lang, rows in frame.groupby("lang")}


def test_held_out_accuracy(samples):
    right = total = 0
    for fold in range(4):
        models = G.train({k: [t for i, t in enumerate(v) if i % 4 != fold] for k, v in samples.items()})
        for lang, texts in samples.items():
            out = [G.plain(t) for i, t in enumerate(texts) if i % 4 == fold]
            best, confidence, accepted = models.classify(out)
            right += sum(models.languages[b] == lang for b in best)
            total += len(out)
            assert accepted.all() and (confidence > 0.5).all()
    assert right == total


def plain_model(texts, order=G.ORDER):
    """Interpolated Kneser-Ney probabilities by the textbook, for one language."""
    counts = {order: Counter()}
    for text in texts:
        padded = "\x02" * (order - 1) + text + "\x03"
        counts[order].update(padded[i : i + order] for i in range(len(padded) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def probability(context, char, base):
        n = len(context) + 1
        ones, twos = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        discount = min(max(ones / max(1, ones + 2 * twos) or 0.5, 0.1), 0.9)
        lower = probability(context[1:], char, base) if context else base
        total = sum(c for g, c in counts[n].items() if g[:-1] == context)
        if not total:
            return lower
        kinds = sum(g[:-1] == context for g in counts[n])
        return max(counts[n][context + char] - discount, 0) / total + discount * kinds / total * lower

    return probability


def test_entropies_equal_the_textbook():
    texts = {"de": ["der eine der", "die andere"], "en": ["the one and", "an other the"]}
    models = G.Models(texts)
    for language in texts:
        k, model = models.languages.index(language), plain_model(texts[language])
        for text in ("der and", "xyz", "thé one", "d"):
            padded = "\x02" * (G.ORDER - 1) + text + "\x03"
            total = 0.0
            for i in range(G.ORDER - 1, len(padded)):
                char = padded[i]
                base = 0.02 if char == "\x03" else models.base[G._SCRIPT_NAMES.index(G._script(char)), k]
                total -= math.log(model(padded[i - G.ORDER + 1 : i], char, base))
            assert models.entropies([text])[0][k] == pytest.approx(total / (len(text) + 1), rel=1e-4)


def test_hard_scripts(samples):
    models = G.train(samples)
    cases = {
        "水中通路를 設置하고자 하는 所有者는 28日 以內에 申告하여야 한다.": "ko",
        "指定機構應當每73小時测量一次載荷,並將結果記入申報書。": "zh",
        "管理者が届出書を失ったときは、90日以内に再交付を受けることができる。": "ja",
        "THE OWNER SHALL SUBMIT THE SAFETY PLAN.": "en",
    }
    best, _, accepted = models.classify([G.plain(t) for t in cases])
    assert [models.languages[b] for b in best] == list(cases.values()) and accepted.all()


def test_rejects_what_no_language_writes(samples):
    models = G.train(samples)
    _, _, accepted = models.classify([G.plain("ლა მი ნო რე სა ტუ")])
    assert not accepted.any()


def test_sentences_cover_lines_that_go_on():
    text = "The owner shall\nsubmit the plan. 한다.다음 문장이다。次の文。\n| a | b |\n- item one\n끝"
    assert [text[s:e].strip() for s, e in G.sentences(text)] == [
        "The owner shall\nsubmit the plan.", "한다.", "다음 문장이다。", "次の文。", "| a | b |", "- item one", "끝",
    ]


def test_labels(spark):
    labels = ["ko", "KO", "kor", "한국어", "ko_KR", "zh-Hant", "en-US", "Deutsch", "tiếng", "", None, "??", "und", "ko/en", "fr"]
    frame = spark.createDataFrame([(x,) for x in labels], "l string")
    got = [r[0] for r in frame.select(G.label_languages(F.col("l"))).collect()]
    assert got[:8] == [["ko"]] * 5 + [["zh"], ["en"], ["de"]]
    assert got[9:13] == [[]] * 4 and got[13:] == [["ko", "en"], ["fr"]]


def test_cases(spark, samples):
    ko, en, ja = samples["ko"][0], samples["en"][0], samples["ja"][0]
    rows = [
        (1, ko, "ko"), (2, ko, "KOR"), (3, ko, None), (4, ko, " "), (5, ko, "??"), (6, ko, "en"), (7, f"{ko}\n\n{en}", "ko"), (8, f"{ko} (Safety Plan)", "ko"),
        (9, None, "ko"), (10, "", None), (11, "123 -- ...", None), (12, ja * 2000, "ja"), (13, en, "ru"), (3, ko, None),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, found string")
    labelled = spark.read.parquet(f"{DATA}/lang_samples.parquet")
    got = sorted({(r["doc_id"], r["lang"], r["reason"]) for r in G.relabelled(docs, labelled).collect()})
    assert got == [(3, "ko", "missing"), (4, "ko", "missing"), (5, "ko", "missing"), (6, "ko", "wrong"), (7, "en", "mixed"), (7, "ko", "mixed"), (13, "en", "wrong")]
    assert G.relabelled(docs.where("doc_id < 0"), labelled).count() == 0


def test_segments_lie_in_their_text(spark, samples):
    text = f"<p>{samples['de'][0]}</p> {samples['vi'][0]}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = G.detect_segments(docs, spark.read.parquet(f"{DATA}/lang_samples.parquet")).collect()
    assert {r["lang"] for r in rows if r["complete"]} == {"de", "vi"}
    assert all(0 <= r["start_pos"] < r["end_pos"] <= len(text) for r in rows)


FOREIGN = [
    "Le titulaire doit présenter la demande au ministre dans un délai de trente jours.", "Les frais sont à la charge du demandeur.",
    "El titular deberá presentar la solicitud al ministerio en un plazo de treinta días.", "Los gastos corren a cargo del solicitante.",
    "Il titolare deve presentare la domanda al ministero entro trenta giorni.", "Le spese sono a carico del richiedente.",
    "De houder moet de aanvraag binnen dertig dagen bij het ministerie indienen.", "De kosten zijn voor rekening van de aanvrager.",
    "Pemegang izin wajib menyampaikan permohonan kepada menteri dalam waktu tiga puluh hari.", "Biaya ditanggung oleh pemohon.",
    "Posiadacz zezwolenia składa wniosek do ministra w terminie trzydziestu dni.", "Koszty ponosi wnioskodawca.", "qzx vbn kjh wrt plm ghj dfg xcv.",
]


def test_languages_without_samples_are_rejected_and_held_out_ones_kept():
    import duckdb

    from statuta.llm import langid as G
    from tests.support import DATA

    rows = duckdb.sql(f"select lang, text from '{DATA}/lang_samples.parquet' order by sample_id").fetchall()
    all_of = {lang: [t for x, t in rows if x == lang] for lang in {x for x, _ in rows}}
    models = G.train({k: v[10:] for k, v in all_of.items()})
    assert not models.classify([G.plain(t) for t in FOREIGN])[2].any()
    held = [(k, t) for k, v in all_of.items() for t in v[:10]]
    best, _, accepted = models.classify([G.plain(t) for _, t in held])
    assert sum(ok and models.languages[b] == k for (k, _), b, ok in zip(held, best, accepted)) > 0.95 * len(held)


def test_labels_are_read_as_whole_names(spark):
    from pyspark.sql import functions as F

    from statuta.llm import langid as G

    want = {
        "Tiếng Việt": ["vi"], "简体中文": ["zh"], "繁體中文": ["zh"], "日本语": ["ja"], "tiếng anh": ["en"], "ko/en": ["ko", "en"], "en, de": ["en", "de"],
        "zh-Hant": ["zh"], "ko_KR": ["ko"], "Korean (South)": ["ko"], "unknown": [], "??": [], "": [], None: [], "lang: de": ["de"],
    }
    frame = spark.createDataFrame([(k,) for k in want], "lang string")
    got = {r[0]: r[1] for r in frame.select("lang", G.label_languages(F.col("lang"))).collect()}
    assert got == want


def test_every_document_with_words_has_a_row(spark):
    from statuta.llm import langid as G
    from tests.support import DATA

    samples = spark.read.parquet(f"{DATA}/lang_samples.parquet")
    docs = spark.createDataFrame([(1, "shall be measured every hour"), (2, "qzx vbn kjh wrt"), (3, None), (4, " 12 "), (5, "별표 제3호의 서식")], "doc_id long, text string")
    rows = G.document_languages(G.detect_segments(docs, samples), every=True).collect()
    assert {(r["doc_id"], r["lang"], r["complete"]) for r in rows} == {(1, "en", False), (2, None, False), (5, "ko", False)}
