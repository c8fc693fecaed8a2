import random

from statuta.llm import leakage as L

KO = "새벽에 창고 서기가 나선 급이기 {n}대를 돌리다가 사슬 고리가 닳아 {x} 쪽의 굴대가 두 동강 났다."
NOUNS = ["바위나루", "달보람공방", "이슬농원", "푸른제재소", "갈대선착장", "여울작업장"]
FILL = "관할 행정청은 해마다 3월까지 설치 현황을 종합하여 대장으로 펴낸다."


def items_of(n, seed=0):
    rng = random.Random(seed)
    words = ["격자 부표", "흙벽돌 압착기", "염전 갈퀴차", "수문 두 칸", "배선 피복", "등유에 물이", "장화를 신은", "계기판 유리", "종이 자루", "왜가리 둥지", "소금 빻는틀", "도르래가 거꾸로"]
    return [(i, " ".join(f"{rng.choice(NOUNS)}의 {rng.choice(words)} {rng.randint(10, 999)}개와 {rng.choice(words)} 때문에 {rng.choice(words)} 멈추었다." for _ in range(3))) for i in range(n)]


def best(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_edit_search_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        a = "".join(rng.choice("가나다") for _ in range(rng.randint(1, 90)))
        b = "".join(rng.choice("가나다") for _ in range(rng.randint(0, 60)))
        assert L.edit_search(a, b)[0] == best(a, b)


def run(spark, docs, items, **extra):
    d = spark.createDataFrame([(i, t, 0.0) for i, t in docs], "doc_id long, text string, distance double")
    e = spark.createDataFrame(items, "item_id long, passage string")
    return {(r["doc_id"], r["item_id"]) for r in L.leaks(d, e).collect()}


def test_against_brute_force(spark):
    rng, items = random.Random(1), items_of(40)
    docs = []
    for k in range(150):
        parts = [FILL] * rng.randint(1, 4)
        if k % 3 == 0:
            sentence = rng.choice(rng.choice(items)[1].split(". ")).rstrip(".") + "."
            words = sentence.split()
            if k % 2:
                words[rng.randrange(len(words))] = "다른"
            parts.insert(rng.randint(0, len(parts)), ("" if k % 4 else " ").join(words))
        docs.append((k, "\n".join(parts)))
    want, close = set(), set()
    for doc, text in docs:
        for item, passage in items:
            for sentence in L.passage_sentences(passage):
                share = best(sentence, L.reduced(text)) / len(sentence)
                if share <= L.ALTERED:
                    want.add((doc, item))
                if share <= 0.15:
                    close.add((doc, item))
    got = run(spark, docs, items)
    assert close <= got <= want and len(got) >= 0.9 * len(want)


def test_standing_phrases_are_no_leaks(spark):
    phrase = "이 규정은 알린 날부터 여섯 달 뒤에 쓰기 시작한다."
    docs = [(i, f"{NOUNS[i % 6]}의 {i}번째 글로서 서로 다르다. {phrase} 그 뒤의 {i * 7}번 말이 이어진다.") for i in range(60)]
    items = [(1, f"{phrase} {KO.format(n=12, x='바위나루')}"), (2, "염전 갈퀴차를 몰던 교대 조장은 장부에 연필로만 적어 두었다.")]
    docs += [(100, f"앞말이다. {KO.format(n=12, x='바위나루')} 뒷말이다.")]
    assert run(spark, docs, items) == {(100, 1)}


def test_copies_of_a_leaking_text_are_all_reported(spark):
    text = f"앞말이다. {KO.format(n=12, x='바위나루')} 뒷말이다."
    docs = [(i, text) for i in range(40)] + [(i, f"{FILL} {i}") for i in range(40, 80)]
    assert run(spark, docs, [(1, KO.format(n=12, x="바위나루"))]) == {(i, 1) for i in range(40)}


def test_nulls_blanks_long_texts_and_empty_tables(spark):
    leak = KO.format(n=5, x="이슬농원")
    docs = [(1, None), (2, ""), (3, " \n"), (4, FILL * 3000 + leak + FILL * 3000), (5, "<b>" + leak.replace(" ", "　") + "</b>")]
    assert run(spark, docs, [(7, leak), (8, None), (9, ""), (10, "짧다."), (11, leak)]) == {(4, 7), (4, 11), (5, 7), (5, 11)}
    assert run(spark, [], [(7, leak)]) == set() and run(spark, docs, []) == set()


def test_short_sentences_and_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 2)
    items = [(i, f"{w} 멈추었다.") for i, w in enumerate(["격자 부표가", "염전 갈퀴차가", "흙벽돌 압착기가", "삼단 훈증실이", "배선 피복이"])]
    docs = [(i, f"{FILL} {p} {FILL}") for i, (_, p) in enumerate(items)]
    assert run(spark, docs, items) == {(i, i) for i in range(5)}


def test_a_frequent_leak_is_no_standing_phrase(spark):
    first, second = KO.format(n=12, x="바위나루"), "염전 갈퀴차를 몰던 교대 조장은 장부에 연필로만 적어 두었다."
    around = lambda i, leak: f"{NOUNS[i % 6]}의 {i}번째 글로서 서로 다르다. {leak} 그 뒤의 {i * 7}번 말이 이어진다."
    docs = [(i, around(i, f"{first} {second}")) for i in range(30)] + [(i, around(i, first)) for i in range(30, 45)]
    docs += [(i, f"{FILL} {i}") for i in range(45, 90)]
    assert run(spark, docs, [(1, f"{first} {second}"), (2, f"{first} {second}")]) == {(i, k) for i in range(45) for k in (1, 2)}
    assert run(spark, docs[30:], [(1, first)]) == {(i, 1) for i in range(30, 45)}


def test_a_sentence_of_several_passages_needs_a_neighbour(spark):
    phrase, own = "이 규정은 알린 날부터 여섯 달 뒤에 쓰기 시작한다.", KO.format(n=12, x="바위나루")
    other = "염전 갈퀴차를 몰던 교대 조장은 장부에 연필로만 적어 두었다."
    docs = [(i, f"{NOUNS[i % 6]}의 {i}번째 글로서 서로 다르다. {phrase} {own if i < 20 else ''} 그 뒤의 {i * 7}번 말이 이어진다.") for i in range(60)]
    assert run(spark, docs, [(1, f"{phrase} {own}"), (2, f"{phrase} {other}")]) == {(i, 1) for i in range(20)}


def test_short_sentences_are_found_with_a_changed_letter():
    rng = random.Random(4)
    letters = [chr(c) for c in range(0xAC00, 0xD7A0)]
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for size in (8, 9, 10, 12, 15):
        sentences = [word(size) for _ in range(100)]
        index = L.Index(sentences)
        same = [word(9) + s + word(11) for s in sentences]
        other = [word(9) + s[: (at := rng.randrange(size))] + "가" + s[at + 1 :] + word(11) for s in sentences]
        for texts in (same, other):
            assert {(t, k) for t, k, *_ in L.matches(texts, index)} == {(k, k) for k in range(100)}


def test_a_single_sentence_is_a_leak_until_many_documents_use_it(spark):
    leak = KO.format(n=12, x="바위나루")
    rng = random.Random(8)
    fill = lambda: " ".join("".join(chr(rng.randrange(0xAC00, 0xD7A0)) for _ in range(4)) for _ in range(6)) + "."
    for n in (5, 19):
        docs = [(i, f"{fill()} {leak if i < n else ''} {fill()}") for i in range(1000)]
        assert run(spark, docs, [(1, f"{leak} {FILL}")]) == {(i, 1) for i in range(n)}


def test_the_report_names_standing_phrases_with_a_reason(spark):
    phrase, own = "이 규정은 알린 날부터 여섯 달 뒤에 쓰기 시작한다.", KO.format(n=12, x="바위나루")
    d = spark.createDataFrame([(1, f"앞말이다. {phrase} 뒷말이다."), (2, f"앞말이다. {own} 뒷말이다.")], "doc_id long, text string")
    e = spark.createDataFrame([(1, f"{phrase} {own}"), (2, f"{phrase} {FILL}")], "item_id long, passage string")
    got = {(r["item_id"], r["documents"], r["passed_over"], r["reason"]) for r in L.leak_report(d, e).collect()}
    assert got == {(1, 1, 0, None), (1, 0, 1, "shared by unlike passages"), (2, 0, 1, "shared by unlike passages")}
