"""Column functions for the wording and numbering of statutes.

Everything here is a composition of built-in functions, so it stays inside the
JVM and can be pushed through by the optimizer.  White space of all scripts is
trimmed; a missing value gives a null unless stated otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the circled numbers 1 to 20, in order.
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
# The patterns of article, paragraph, item and annex citations.
ARTICLE = r"(?:제\s*)?(\d+)\s*조(?:\s*의\s*(\d+))?"
QUERY_PARAGRAPH = r"(?:제\s*)?([0-9①-⑳]+)\s*항"
QUERY_ITEM = r"(?:제\s*)?(\d+)\s*호"
ANNEX_REF = r"별표\s*(\d+)(?:\s*의\s*(\d+))?"
AMENDED = r"<\s*개정[^>]*>"
DOTTED_DATE = r"\d{4}\.\d{1,2}\.\d{1,2}"

_WS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def group(column: Column, pattern: str, index: int) -> Column:
    """Group ``index`` of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(column, pattern, index), F.lit(""))


def let(column: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a column that is computed once, however often it is used there."""
    return F.element_at(F.transform(F.array(column), function), 1)


def strip(column: Column) -> Column:
    """The text without white space at both ends."""
    return F.regexp_replace(column, f"^[{_WS}]+|[{_WS}]+$", "")


def squash(column: Column) -> Column:
    """Runs of white space as one space, none at the ends; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(column, f"[{_WS}]+", " ")), F.lit(""))


def filled(column: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(column, F.lit(""))


def paragraph_number(column: Column) -> Column:
    """A circled number by itself, else the first run of digits."""

    def read(bare: Column) -> Column:
        circled = F.when(F.length(bare) == 1, F.nullif(F.instr(F.lit(CIRCLED), bare), F.lit(0)))
        return F.coalesce(circled, group(bare, r"(\d+)", 1).try_cast("int"))

    return let(strip(column), read)


def item_number(column: Column) -> Column:
    """``2.`` and ``2`` as 2; lettered items have no number."""
    return group(column, rf"^[{_WS}]*(\d+)[{_WS}]*\.?[{_WS}]*$", 1).try_cast("int")


def branch(number: Column, sub: Column) -> Column:
    """``4`` or ``4의2``; null without a number."""
    return F.concat(number, F.coalesce(F.concat(F.lit("의"), sub), F.lit("")))


def article(*columns: Column) -> Column:
    """Struct (norm, num, suffix) of the article that the columns name.

    Of all columns' first citations the first with a branch number wins, else
    the first of all.
    """
    cited = F.transform(
        F.array(*columns),
        lambda c: F.struct(F.regexp_extract(c, ARTICLE, 1).alias("n"), filled(F.regexp_extract(c, ARTICLE, 2)).alias("s")),
    )
    found = F.filter(cited, lambda c: F.coalesce(c["n"], F.lit("")) != "")
    best = let(found, lambda f: F.coalesce(F.get(F.filter(f, lambda c: c["s"].isNotNull()), F.lit(0)), F.get(f, F.lit(0))))
    return let(
        best,
        lambda b: F.struct(
            branch(b["n"], b["s"]).alias("norm"), b["n"].try_cast("int").alias("num"), b["s"].try_cast("int").alias("suffix")
        ),
    )


def article_path(jo: Column) -> Column:
    """``제4조의2`` of ``4의2``; anything else as it is."""
    shape = r"^\s*(\d+)(?:\s*의\s*(\d+))?\s*$"

    def read(j: Column) -> Column:
        num, sub = (group(j, shape, k).try_cast("bigint").cast("string") for k in (1, 2))
        shown = F.concat(F.lit("제"), num, F.lit("조"), F.coalesce(F.concat(F.lit("의"), sub), F.lit("")))
        return F.coalesce(shown, filled(j))

    return let(jo, read)


def display_path(jo: Column, hang: Column, mok: Column) -> Column:
    """``제4조의2 제1항 제2호``; zeros and nulls are left out."""
    return F.concat_ws(
        " ",
        article_path(jo),
        F.when(hang != 0, F.concat(F.lit("제"), hang.cast("string"), F.lit("항"))),
        F.when(mok != 0, F.concat(F.lit("제"), mok.cast("string"), F.lit("호"))),
    )


def amendment_dates(column: Column) -> Column:
    """ISO dates inside amendment tags, each once, in order of appearance; not checked against the calendar."""
    tags = F.regexp_extract_all(column, F.lit(AMENDED), F.lit(0))
    dates = F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(t, F.lit(DOTTED_DATE), F.lit(0))))
    parts = F.transform(dates, lambda d: F.split(d, r"\."))
    iso = F.transform(parts, lambda p: F.concat_ws("-", p[0], F.lpad(p[1], 2, "0"), F.lpad(p[2], 2, "0")))
    return F.coalesce(F.array_distinct(iso), F.array().cast("array<string>"))


def annex_references(column: Column) -> Column:
    """Numbers of the annexes a text cites, each once, shorter ones first."""
    whole = F.regexp_extract_all(column, F.lit(ANNEX_REF), F.lit(0))
    numbers = F.transform(
        whole,
        lambda m: branch(
            group(m, ANNEX_REF, 1).try_cast("bigint").cast("string"), group(m, ANNEX_REF, 2).try_cast("bigint").cast("string")
        ),
    )
    known = F.array_distinct(F.filter(numbers, lambda n: n.isNotNull()))
    ranked = F.array_sort(F.transform(known, lambda n: F.struct(F.length(n).alias("size"), n.alias("n"))))
    return F.coalesce(F.transform(ranked, lambda r: r["n"]), F.array().cast("array<string>"))


def annex_number(column: Column) -> Column:
    """``4-2``, ``4/2``, ``4 의 2`` as ``4의2``; anything else trimmed."""
    return F.regexp_replace(filled(strip(column)), r"^(\d+)\s*(?:[-_/]|의)\s*(\d+)$", "$1의$2")


def annex_number_human(column: Column) -> Column:
    """Six digits read as four of the number and two of its branch; '' for none,
    null where it isn't a number."""

    def read(code: Column) -> Column:
        head, tail = F.substring(code, 1, 4).try_cast("int"), F.substring(code, 5, 100).try_cast("int")
        human = F.concat(head.cast("string"), F.when(tail != 0, F.concat(F.lit("의"), tail.cast("string"))).otherwise(""))
        return F.when(code.rlike(r"^\d+$"), human)

    code = F.when(F.length(column) < 6, F.lpad(column, 6, "0")).otherwise(column)
    return F.when(F.coalesce(column, F.lit("")) == "", "").otherwise(let(code, read))


def as_of_date(column: Column) -> Column:
    """The date in the first ten characters, if it is three numbers parted by dashes."""
    shape = r"^\s*(\d+)\s*-\s*(\d+)\s*-\s*(\d+)\s*$"

    def read(head: Column) -> Column:
        parts = [group(head, shape, k).try_cast("int") for k in (1, 2, 3)]
        text = F.format_string("%04d-%02d-%02d", *parts)
        return F.when(head.rlike(shape) & (parts[0] <= 9999), F.try_to_date(text, "yyyy-MM-dd"))

    return let(F.left(strip(column), F.lit(10)), read)


def citation(column: Column) -> Column:
    """Struct (jo, hang, mok) of the article, paragraph and item a question names."""
    num = group(column, r"(?:제\s*)?(\d+)\s*조\s*(?:의\s*(\d+))?", 1)
    sub = group(column, r"(?:제\s*)?(\d+)\s*조\s*(?:의\s*(\d+))?", 2)
    return F.struct(
        branch(num, sub).alias("jo"),
        paragraph_number(group(column, QUERY_PARAGRAPH, 1)).alias("hang"),
        group(column, QUERY_ITEM, 1).try_cast("int").alias("mok"),
    )


# Fixed value: the pattern of a law's name before the word for its annexes.
NAMED_ANNEX = r"[\"'“”‘’]?([가-힣A-Za-z0-9·ㆍ\s]+?)[\"'“”‘’]?\s*의\s*별표"


def annex_intent(column: Column) -> Column:
    """Struct (law_name, number) of a question for an annex."""
    number = group(column, r"별표\s*(\d+)", 1).try_cast("int")
    return F.struct(
        F.when(number.isNotNull(), filled(strip(F.regexp_extract(column, NAMED_ANNEX, 1)))).alias("law_name"),
        number.alias("number"),
    )


def article_code(column: Column) -> Column:
    """Six-digit code of an article number: ``10의2`` gives ``001002``."""
    digits = F.regexp_extract_all(column, F.lit(r"\d+"), F.lit(0))
    main, sub = F.get(digits, F.lit(0)).try_cast("int"), F.get(digits, F.lit(1)).try_cast("int")
    return F.when(main.isNotNull(), F.format_string("%04d%02d", main, F.coalesce(sub, F.lit(0))))


def plain_number(column: Column) -> Column:
    """A number without leading zeros; null where it isn't one."""
    return F.when(column.rlike(r"^\d+$"), F.coalesce(filled(F.ltrim(column, F.lit("0"))), F.lit("0"))).try_cast("int")


def safe_filename(column: Column) -> Column:
    """Runs of characters that file systems refuse as one underscore."""
    return strip(F.regexp_replace(column, r'[/:*?"<>|]+', "_"))


def bare_filename(column: Column) -> Column:
    """A name without the characters that file systems refuse."""
    return F.regexp_replace(column, r'[\\/*?:"<>|]', "")


def iso_time(column: Column) -> Column:
    """A time in ISO form, to the second."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


def title_of_base(base: Column, mst: Column) -> Column:
    """The title in a base name ``title_mst``; null for other names and empty titles."""
    tail = F.concat(F.lit("_"), mst)
    return F.when(F.endswith(base, tail), filled(F.left(base, F.length(base) - F.length(tail))))


def article_with_fallback(jo: Column, text: Column) -> Column:
    """``4`` or ``4의2`` out of an article field, else out of the first article a text names."""

    def read(column: Column, pattern: str) -> Column:
        value = F.trim(F.coalesce(column, F.lit("")))
        number, branch = (filled(F.regexp_extract(value, pattern, k)) for k in (1, 2))
        return F.concat(number, F.coalesce(F.concat(F.lit("의"), branch), F.lit("")))

    return F.coalesce(read(jo, r"(\d+)(?:\s*의\s*(\d+))?"), read(text, r"제\s*(\d+)\s*조\s*(?:의\s*(\d+))?"))


def composed(column: Column) -> Column:
    """Canonical composition (NFC); only texts with combining marks or single jamo reach Python."""

    @F.pandas_udf("string")
    def compose(values):  # noqa: ANN001, ANN202
        import unicodedata

        return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))

    apart = column.rlike("[\\u0300-\\u036f\\u1100-\\u11ff\\u3099\\u309a]")
    return F.coalesce(compose(F.when(apart, column)), column)


def slug(column: Column, size: int = 80) -> Column:
    """A short file name part: forbidden and unprintable characters out."""
    bare = F.regexp_replace(composed(column), r'[\\/:*?"<>|]+', " ")
    bare = F.regexp_replace(bare, r"[\p{C}\p{Zl}\p{Zp}]", "")
    return F.regexp_replace(F.left(squash(bare), F.lit(size)), r"\s+$", "")


def absolute_url(column: Column, base: str) -> Column:
    """A link with its host: relative ones get ``base``."""
    return F.when(F.startswith(column, F.lit("http")), filled(column)).otherwise(F.concat(F.lit(base), filled(column)))


def unit_path(jo: Column, hang: Column, mok: Column) -> Column:
    """``제14조 > 제③항 > 2.호`` of the raw numbers."""
    seg = F.when(F.endswith(mok, F.lit(".")), F.concat(mok, F.lit("호"))).otherwise(F.concat(mok, F.lit(".호")))
    return F.concat_ws(
        " > ",
        F.concat(F.lit("제"), filled(jo), F.lit("조")),
        F.concat(F.lit("제"), filled(hang), F.lit("항")),
        F.when(filled(mok).isNotNull(), seg),
    )


def snippet(column: Column, size: int = 160) -> Column:
    """Line breaks as spaces, cut to ``size`` with an ellipsis."""
    flat = F.replace(F.coalesce(column, F.lit("")), F.lit("\n"), F.lit(" "))
    return F.when(F.length(flat) > size, F.concat(F.left(flat, F.lit(size)), F.lit("..."))).otherwise(flat)


_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def clean_lines(column: Column) -> Column:
    """Each line without trailing white space, none around the whole."""
    lines = F.split(F.coalesce(column, F.lit("")), _LINE_BREAK)
    return strip(F.array_join(F.transform(lines, lambda s: F.regexp_replace(s, f"[{_WS}]+$", "")), "\n"))


# Labels that surround an annex without being its content.
ANNEX_LABELS = ("별표·서식", "별표 · 서식", "별표 ·서식", "별표· 서식", "첨부파일", "다운로드", "보기", "목록", "프린트", "인쇄")


def is_meaningful(text: Column, cells: Column | None = None, least: int = 100) -> Column:
    """Whether an annex body is more than labels: long enough, or with a filled table cell."""
    bare = F.coalesce(text, F.lit(""))
    for label in ANNEX_LABELS:
        bare = F.replace(bare, F.lit(label), F.lit(""))
    long_enough = F.length(squash(bare)) >= least
    if cells is None:
        return long_enough
    return long_enough | F.coalesce(F.exists(cells, lambda c: filled(strip(c)).isNotNull()), F.lit(False))


def fingerprint(column: Column) -> Column:
    """First 16 hexadecimal digits of the text's SHA-256; null counts as ''."""
    return F.left(F.sha2(F.coalesce(column, F.lit("")), 256), F.lit(16))


def table_runs(column: Column, keep: int = 2) -> Column:
    """The first ``keep`` rows of each run of table lines, joined by a space."""
    lines = F.transform(F.split(F.coalesce(column, F.lit("")), _LINE_BREAK), strip)
    start = F.struct(F.array().cast("array<array<string>>").alias("runs"), F.lit(False).alias("open"))

    def step(acc: Column, line: Column) -> Column:
        row = F.startswith(line, F.lit("|")) & F.endswith(line, F.lit("|"))
        last = F.element_at(acc["runs"], -1)
        grown = F.concat(
            F.slice(acc["runs"], F.lit(1), F.greatest(F.size(acc["runs"]) - 1, F.lit(0))),
            F.array(F.when(F.size(last) < keep, F.concat(last, F.array(line))).otherwise(last)),
        )
        runs = F.when(row & acc["open"], grown).when(row, F.concat(acc["runs"], F.array(F.array(line)))).otherwise(acc["runs"])
        return F.struct(runs.alias("runs"), row.alias("open"))

    return F.transform(F.aggregate(lines, start, step, lambda a: a["runs"]), lambda r: F.array_join(r, " "))
