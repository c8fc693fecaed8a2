"""Template residue, filler and error-page text in units that should hold a law's wording.

Templates are induced from the whole corpus.  Every value is cut into lines and
sentences, and equal segments (numbers aside) become one row with the number of
their units and the spread of their laws.  Segments are then aligned:

* Words that stand in at least ``ANCHOR`` of all values are anchors.  Segments
  with the same anchors at the same places are records of one template, and the
  places between them at which records differ are its *slots*.
* A segment that fills whole values of unlike laws is a *page* if the corpus has
  its words nowhere in running text: most of them, and the one that closes it.
  Laws repeat provisions and headings too, but with words that laws use.

What was induced is then judged, once for each distinct segment.  Residue is

* a slot that keeps a variable name in a placeholder's delimiters, a default
  literal (``undefined``, ``#REF!`` ...) or nothing at all.  Delimiters that laws
  use themselves (single braces, angle and square brackets) count where the slot
  is an induced one, which other records fill with words, around a name that the
  corpus also shows in unmistakable delimiters, or where nothing else stands;
* filler: dummy words, the same token over and over, alphabet runs;
* a page, whatever its words; and a message in the words of error pages and
  demands for scripts even if it stands once.  Wording that merely resembles a
  message counts only if its template is repeated.

The word lists below name the kind of what stands once; whatever repeats is found
without them.

Cost: anchors are one aggregate, the distinct segments another; the shuffle holds
each distinct segment of a scan task once, and Python sees each once.  Units are
joined to the judged segments by the segments' hashes.

Defined results: null and blank values, a dash and the default title ``별표/서식``
are no residue; a unit is reported once however many segments it has; a unit id
given twice is reported once; without a ``law`` column each unit is its own law.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.session import durable

#: Least number of records of a template that only resembles a message.
REPEATED = 2
#: Share of all values in which a word must stand to be an anchor.  Its inverse,
#: times the words of a value, bounds how many anchors there are.
ANCHOR = 0.01
#: A page fills at least so many whole values, and this share of its words, with
#: the closing one, stands in no running text.
PAGE_LEAST, PAGE_FOREIGN = 3, 0.6
#: Longest stretch (without white space) that is filler when it comes again and
#: again; longer ones are sentences given twice.
PERIOD = 20
#: Judged segments up to this number are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Words and slots that a task holds before it hands them on.
HELD = 200_000

_NAME = r"[A-Za-z가-힣_][A-Za-z가-힣0-9_.\-]*(?: [A-Za-z가-힣0-9_.\-]+){0,3}"
_GAP = r"[ \t]*"
# Delimiters that only templates use.
_SURE_SLOT = re.compile(
    rf"\{{\{{[#/^>&!]?{_GAP}(?:(?:if|each|unless|with|else)\b{_GAP})?(?P<a>{_NAME})?{_GAP}\}}\}}"
    rf"|[$#]\{{{_GAP}(?P<b>{_NAME})?{_GAP}\}}"
    rf"|\{{%[-+]?{_GAP}(?P<c>{_NAME})?[^%\n]{{0,40}}%\}}"
    rf"|<%[=\-#]?{_GAP}(?P<d>{_NAME})?[^%\n]{{0,40}}%>"
    rf"|%\((?P<e>{_NAME})\)[sd]"
    rf"|(?<![_\w])__(?P<f>[A-Za-z가-힣][A-Za-z가-힣0-9.\-]*(?:_[A-Za-z가-힣0-9.\-]+)*)__(?![_\w])"
    rf"|@@{_GAP}(?P<g>{_NAME}){_GAP}@@"
    rf"|\[\[{_GAP}(?P<h>{_NAME}){_GAP}\]\]"
    rf"|«{_GAP}(?P<i>{_NAME}){_GAP}»"
    rf"|\$(?P<j>[A-Za-z가-힣_][A-Za-z가-힣0-9_.]*)\$"
    rf"|&lt;{_GAP}(?P<k>{_NAME}){_GAP}&gt;"
    # any doubled sign that closes as it opened, and any sign before a brace
    rf"|(?P<open>%%|##|@@|<<|\[\[|\{{\{{){_GAP}(?P<m>{_NAME})[^\n.。{{}}<>%#@\]]{{0,60}}(?:%%|##|@@|>>|\]\]|\}}\}})"
    rf"|[$#%]\{{{_GAP}(?P<n>{_NAME})?[^{{}}\n]{{0,60}}\}}"
    rf"|[\[(<]{_GAP}(?:TODO|FIXME|TBD)\b[: ]*(?P<l>{_NAME})?[^\])>\n]{{0,20}}[\])>]",
    re.IGNORECASE,
)
# Delimiters that laws use as well.
_WEAK_SLOT = re.compile(
    rf"\{{{_GAP}(?P<a>[A-Za-z가-힣_][A-Za-z가-힣0-9_.\-]+){_GAP}\}}"
    rf"|[\[(<（]{_GAP}(?:여기에|이곳에){_GAP}(?P<b>{_NAME}?){_GAP}(?:을\(를\)|을|를)?{_GAP}(?:입력|기재|작성|삽입)[^\])>）\n]{{0,8}}[\])>）]"
    rf"|[\[(<（]{_GAP}(?P<c>{_NAME}?)(?:을\(를\)|을|를)?{_GAP}(?:입력|기재|작성|삽입)(?:하세요|하십시오|바람|란|요망)?{_GAP}[\])>）]"
    rf"|<{_GAP}(?P<d>[A-Za-z가-힣_][A-Za-z가-힣0-9_.\-]+){_GAP}>",
    re.IGNORECASE,
)
# Literals that stand where a program had no value.
_DEFAULT = re.compile(
    r"\[object [A-Za-z]+\]|#(?:REF|VALUE|N/A|NAME|DIV/0|NULL|NUM)[!?]?|(?<![A-Za-z0-9_\"'“‘.])(?:undefined|null|none|nan|nil)(?![A-Za-z0-9_\"'”’.])",
    re.IGNORECASE,
)
_ID = re.compile(r"\b(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f]|\d{8}\b)[0-9a-f]{8}\b")
_DIGITS = re.compile(r"\d+")

_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\n\r\v\f\x85]+")
_HANGUL, _LATIN = re.compile(r"[가-힣]"), re.compile(r"[A-Za-z]")

# Words of dummy text.
_LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et "
    "dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea "
    "commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
# Runs of an alphabet or a keyboard row that stand for text.
_RUNS = ("가나다라마바사아자차카타파하", "abcdefghijklmnopqrstuvwxyz", "qwertyuiop", "asdfghjkl", "zxcvbnm", "ㅁㄴㅇㄹㅎㅗㅓㅏㅣ")
_JAMO = re.compile(r"[ㄱ-ㅣ]")
#: What stands for a missing value.
NO_VALUE = ("", "-", "별표/서식")
_JUNK = re.compile(r"[ㄱ-ㅣ]{3,}|(?:lorem|ipsum|dolor)[a-z]*")
# Signs that rule off tables and are no filler.
_RULE = re.compile(r"[-=_─━═~*.·|+\s]*\Z")

# The tests below see a text in lower case and without white space.
_DUMMY = re.compile(
    r"(?:견본|샘플|예시|더미|임시|기본|가짜|테스트|dummy|sample|placeholder)(?:용)?(?:글|문구|문단|본문|텍스트|내용|데이터|자료|입력|등록|중입|text|data)(?!의|[을를은는이가](?!들어|자리))"
    r"|눌러서?(?:내용을)?편집|나중에바꿀|실제내용으로(?:교체|바꾸|변경)|추후(?:등록|입력|작성)(?:예정|될|할)|작성예정|지우지마|화면확인용|배치확인"
    r"|여기에(?:본문|내용|제목|텍스트)(?:이|을|를)(?:들어|입력|넣)"
    r"|your(?:text|content|title)goeshere|clicktoedit|(?:dummy|sample)textfor|tobe(?:added|announced|determined)|comingsoon"
)
_TESTING = re.compile(r"(?:테스트|test|asdf|qwer){2,}[0-9a-z가-힣]*|(?:테스트){1,}(?:데이터|입력|등록|확인용|중)+[가-힣]*")
#: Address of the reader, which statutes never use.
_POLITE = re.compile(r"(?:니다|시오|세요|어요|아요|해요)(?![가-힣])")
_MESSAGE_KO = re.compile(
    r"찾을수없|표시할수없|불러올수없|불러오지못|불러오는중|열수없|볼수없|처리하는중|처리할수없|제공하지않|지원하지않|존재하지않|삭제되었거나|이동되었"
    r"|오류가발생|오류입니다|만료되|점검중|차단되|감지되|허용되지않|권한이없|인증에실패|등록되지않은|한도를초과|초과하였습"
    r"|다시시도|새로고침|다시접속|다시로그인|로그인화면|처음부터다시|문의하|알려주|확인하여주|확인하세요|기다려주|죄송합|불편을드려|돌아가"
    r"|브라우저|스크립트|script|쿠키를|켜야|꺼져|미지원|허용이필요|설정을확인|사용을허용|접속키|(?:페이지|화면|서버|접속|시스템|연결|네트워크)(?:의|에)?(?:오류|에러|장애)|서비스안내|요청하신|찾으시는|입력하신|이게시물"
)
#: A law speaking of itself, which no page does.
_LAW = re.compile(r"(?:^|\s)(?:이|같은)\s?(?:법|영|규칙|조례|고시|훈령|예규|조|항)(?:은|는|에|의|을|를|이|과)|제\s?\d+조")
# Words for comparison, without signs and numbers.
_WORD = re.compile(r"[^\W\d_]+")
# Notes of editors that stand alone, with or without a date.
_EDITED = re.compile(r"[\[<(](?:본조|본항|본호|전문|제목|종전|신설|개정|삭제|시행)|[\[<(][^\])>]*\d\.\s?\d+\.\s?\d|(?:삭제|생략)\b")
#: Ends of notes and headings, which need no verb; a whole value of a message's
#: wording that ends so is one if its template repeats.
_NOTE = re.compile(r"(?:[음됨함임중]|불가|실패|오류|에러|장애)[.!)]*\Z")
_MESSAGE_EN = re.compile(
    r"(?:java)?script(?:s|ing)?(?:andcookies)?(?:is|are)?(?:required|seemstobe|disabled|seemtobe)|without(?:java)?script|doesnotsupport|(?:needto|please)(?:enable|allow|turnon|activate)"
    r"|notfound|couldnotbe|cannotbe(?:found|displayed|loaded)|temporarilyunavailable|serviceunavailable|badrequest|badgateway|gatewaytime-?out|internalservererror|toomanyrequests"
    r"|methodnotallowed|notacceptable|requesttimeout|proxyerror|didnotrespond|hasexpired|wasremoved|nolongeravailable|downformaintenance|undermaintenance|connection(?:refused|reset|closed|timedout)"
    r"|tryagainlater|contactthe(?:administrator|site)|checktheaddress|gobackto|accessdenied|permissiondenied|pageyourequested|requestedresource|(?<![a-z])unauthorized|(?<![a-z])forbidden"
    r"|(?<![a-z])error:?\(?\d{3}|httperror|httpstatus\d|(?<![a-z])(?:[1-5]\d\d)(?:ok|moved|found)(?![a-z])"
)
_MACHINE = re.compile(
    r"</?(?:html|head|body|title|h1|noscript|script|div|span|iframe|meta|center|hr)\b[^>]{0,80}>|^http/\d|content-length:|content-type:|sqlstate\[|traceback\(mostrecent"
    r"|(?:exception|error):[^가-힣]*$|(?:[a-z]+\.){2,}[a-z]*(?:exception|error)\b|(?:^|\t)at[a-z.]+\([a-z]+\.java|file\"[^\"]+\",line\d|[a-z]+\.java:\d+\)"
    r"|^[\[{].{0,12}\"(?:error|fault|result|status|exception)\":|\"(?:code|message|trace)\":|^[a-z]*(?:error|exception)$",
    re.IGNORECASE,
)
# What a text must show for a rule to match at all.  Each is implied by its
# patterns, so leaving a rule out for want of its sign loses nothing.  Two Latin
# letters stand in every alternative of ``_MACHINE`` except ``h1``.
_LETTERS = re.compile(r"[a-z]{2}", re.IGNORECASE)
_SLOT_SIGNS = (*"{$#«<", "%(", "%%", "__", "@@", "[[", "입력", "기재", "작성", "삽입")
_DUMMY_SIGNS = (
    *("견본", "샘플", "예시", "더미", "임시", "기본", "가짜", "테스트", "편집", "나중에바꿀", "실제내용으로", "추후", "작성예정"),
    *("지우지마", "화면확인용", "배치확인", "여기에"),
)
_POLITE_SIGNS = ("니다", "시오", "세요", "어요", "아요", "해요")


def _any(signs: tuple[str, ...], text: str) -> bool:
    return any(sign in text for sign in signs)


def _squeezed(text: str) -> str:
    return "".join(text.split()).lower()


def skeleton(segment: str) -> str:
    """The segment with its slots marked: its template."""
    out = _SURE_SLOT.sub("⟨var⟩", segment)
    out = _WEAK_SLOT.sub("⟨var⟩", out)
    out = _DEFAULT.sub("⟨default⟩", out).lower()
    out = _ID.sub("⟨id⟩", out)
    out = _DIGITS.sub("0", out)
    return re.sub(r"\s+", " ", out).strip()


def is_filler(value: str) -> bool:
    """Whether a whole value is the same thing over and over, or dummy words."""
    bare = _squeezed(value)
    if len(bare) < 3 or _RULE.match(bare):
        return False
    words = [w.strip(".,!?") for w in value.lower().split()]
    if len(words) >= 2 and sum(w in _LOREM for w in words) >= 0.7 * len(words) and any(len(w) > 3 for w in words):
        return True
    letters = re.sub(r"[\d\W_]+", "", bare)
    if len(letters) >= 3 and len(_JAMO.findall(letters)) == len(letters):
        return True
    if len(letters) >= 6 and letters == bare and any(letters in run * 3 for run in _RUNS):
        return True
    # a text is periodic if it occurs in itself doubled before its end
    for text in (bare, letters):
        period = (text + text).find(text, 1) if len(text) >= 4 else len(text)
        if period == len(text) and len(words) > 2 and text is bare:
            # the last repetition may be cut off
            unit = _squeezed(words[0])
            # where it repeats, its first half occurs again
            half, at = text[: len(text) // 2], text.find(text[: len(text) // 2], max(1, len(unit)))
            while 0 < at <= len(text) // 2 and not text.startswith(text[at:]):
                at = text.find(half, at + 1)
            period = at if 0 < at <= len(text) // 2 else period
        if period <= PERIOD and period < len(text) and 2 * period <= len(text) and (len(text) >= 6 or not text.isalnum() or len(words) > 1):
            return True
    return False


def segments(value: str) -> list[str]:
    """Sentences and lines of a value."""
    return [s for s in (p.strip() for p in _SENTENCE.split(value)) if s]


def suspects(value: str | None) -> list[tuple[str, str, int, str | None]]:
    """(template, kind, certainty, variable name) of what a value's segments show."""
    if value is None or value.strip() in NO_VALUE:
        return []
    parts = segments(value)
    found = [x for part in parts for x in judge(part, len(parts) == 1)]
    if _repeats(parts):
        found += judge(" ".join(parts), True)
    return found


def _repeats(parts: list[str]) -> bool:
    """Whether segments of a value occur in it again and again."""
    return len(parts) > 1 and 2 * len({_squeezed(p) for p in parts}) <= len(parts) + 1


def judge(segment: str, whole: bool) -> list[tuple[str, str, int, str | None]]:
    """(template, kind, certainty, variable name) of what a segment shows; ``whole``
    if it is all that its value holds.

    Certainty 2 is residue wherever it stands, 1 needs the corpus: a slot that was
    induced or a name known as a variable (kind ``slot``), or a template repeated
    over records.
    """
    found: list[tuple[str, str, int, str | None]] = []
    tight = _squeezed(segment)
    letters = bool(_LETTERS.search(tight))
    if is_filler(segment) and (whole or len(tight) >= 12 or _JUNK.fullmatch(tight)):
        found.append((skeleton(segment), "filler", 2, None))
    if (letters or "h1" in tight) and (_MACHINE.search(tight) or _MACHINE.search(segment.lower())):
        found.append((skeleton(segment), "error page", 2, None))
    if letters or _any(_SLOT_SIGNS, segment):
        found += _slots(segment)
    latin = len(_LATIN.findall(segment)) if letters else 0
    polite = _any(_POLITE_SIGNS, tight) and bool(_POLITE.search(segment) or _POLITE.search(tight))
    if (letters or _any(_DUMMY_SIGNS, tight)) and _DUMMY.search(tight) and (polite or not tight.rstrip(".!").endswith("다")):
        found.append((skeleton(segment), "filler", 2, None))
    elif _TESTING.fullmatch(tight.strip(".!()")):
        found.append((skeleton(segment), "filler", 2, None))
    elif polite:
        if not _LAW.search(segment):
            found.append((skeleton(segment), "message", 2 if _MESSAGE_KO.search(tight) else 1, None))
    elif whole and _NOTE.search(tight) and _MESSAGE_KO.search(tight):
        found.append((skeleton(segment), "message", 1, None))
    elif latin >= 4 and _MESSAGE_EN.search(tight):
        found.append((skeleton(segment), "message", 2 if latin > len(_HANGUL.findall(segment)) else 1, None))
    return list(dict.fromkeys(found))


def _slots(segment: str) -> Iterator[tuple[str, str, int, str | None]]:
    template = None
    for match in _SURE_SLOT.finditer(segment):
        template = template or skeleton(segment)
        name = next((g for k, g in match.groupdict().items() if g and k != "open"), None)
        yield template, "slot", 2, name.strip().lower() if name else None
    rest = _SURE_SLOT.sub(" ", segment)
    for match in _WEAK_SLOT.finditer(rest):
        template = template or skeleton(segment)
        name = next((g for g in match.groups() if g), "").strip()
        alone = not re.sub(r"[\W_]+", "", _WEAK_SLOT.sub("", rest))
        code = bool(_LATIN.search(name)) and len(name) > 2 and match.group("d") is None
        yield template, "slot", 2 if name and (alone and match.group("d") is None or code) else 1, name.lower()
    if _DEFAULT.search(rest):
        only = not re.sub(r"[\W_]+|제|조|항|호", "", _DEFAULT.sub("", rest))
        yield template or skeleton(segment), "default", 2 if only else 1, None


# --------------------------------------------------------------- segments of a corpus

def _pairs(word: Column) -> Column:
    """Neighbouring characters of a word; the word itself if it has but one."""
    return F.when(F.length(word) > 1, F.regexp_extract_all(word, F.lit("(?=(..))"), 1)).otherwise(F.array(word))


def _zeroed(column: Column) -> Column:
    return F.when(column.rlike(r"\p{L}"), F.regexp_replace(column, r"\d", "0")).otherwise(column)


def unit_segments(units: DataFrame, id_col: str = "unit_id", columns: tuple[str, ...] = ("title", "text"), law: str | None = None) -> DataFrame:
    """id, law (a hash), is_text (of the last column), segment, whole: every segment of every unit."""
    values = F.array(*(F.struct(F.lit(c == columns[-1]).alias("is_text"), F.col(c).alias("value")) for c in columns))
    rows = units.select(F.col(id_col).alias("id"), F.xxhash64(law or id_col).alias("law"), F.explode(values).alias("v"))
    # one step after another, so that none is evaluated twice
    pieces = F.split(F.col("v.value"), r"(?<=[.!?])[\s\p{Z}]+|[\n\r\x0B\f\x85]+")
    kept = rows.where("v.value is not null").select("id", "law", "v.is_text", pieces.alias("raw"))
    kept = kept.select("id", "law", "is_text", F.filter(F.transform("raw", lambda p: F.trim(p)), lambda p: p != "").alias("raw"))
    kept = kept.select("id", "law", "is_text", "raw", F.size("raw").alias("n"))
    # what repeats itself is one more segment
    again = F.when((F.col("n") > 1) & (2 * F.size(F.array_distinct("raw")) <= F.col("n") + 1), F.array_join("raw", " "))
    kept = kept.select("id", "law", "is_text", "raw", "n", again.alias("again"))
    parts = kept.select("id", "law", "is_text", F.expr("n = 1 as single"), F.posexplode(F.when(F.col("again").isNull(), F.col("raw")).otherwise(F.concat("raw", F.array("again")))).alias("at", "part"), "n")
    return parts.where(~F.col("part").isin(*NO_VALUE)).select(
        "id", "law", "is_text", _zeroed(F.col("part")).alias("segment"), (F.col("single") | (F.col("at") == F.col("n"))).alias("whole")
    )


def anchors(units: DataFrame, columns: tuple[str, ...] = ("title", "text")) -> list[str]:
    """The words that stand in at least ``ANCHOR`` of all values."""
    value = F.explode(F.array(*columns)).alias("value")
    words = F.array_distinct(F.split(F.regexp_replace("value", r"\d", "0"), r"(?U)\s+"))
    # an empty word in every value counts the values
    counts = (
        units.select(value).where("value is not null")
        .select(F.explode(F.array_union(words, F.array(F.lit("")))).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.where("word = ''").select(F.col("n").alias("total"))
    kept = counts.where("word <> ''").join(F.broadcast(total), F.col("n") >= ANCHOR * F.col("total"))
    return sorted(r["word"] for r in kept.select("word").collect())


_FOUND = (
    "tag string, hash long, whole boolean, records long, template string, kind string, certainty int, name string, "
    "slots array<long>, words array<string>, low long, high long"
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in _FOUND.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


class _Aligner:
    """Slots of the templates that a task has seen, and the words of running text."""

    def __init__(self, anchors: frozenset[str]):
        self.anchors, self.words, self.slots = anchors, {}, {}

    def places(self, words: list[str]) -> tuple[str, list[int]]:
        """The template of a segment, and which of its words lie in slots."""
        free = [k for k, w in enumerate(words) if w not in self.anchors]
        if len(free) == len(words):
            return "", []
        return " ".join([w if w in self.anchors else "*" for w in words]), free

    def see(self, words: list[str], odd: bool, template: str, free: list[int]) -> None:
        """Count the fillers of a segment's slots, unless it is one that may keep a placeholder."""
        if odd or not template:
            return
        slots = self.slots.setdefault(template, {})
        for k in free:
            known = slots.get(k)
            if known is None:
                slots[k] = words[k]
            elif known is not True and known != words[k]:
                slots[k] = True

    def read(self, words: list[str], units: int) -> None:
        counts = self.words
        for word in words:
            counts[word] = counts.get(word, 0) + units

    def hand_on(self) -> list[tuple]:
        rows = [("word", None, None, n, None, None, None, word, None, None, None, None) for word, n in self.words.items()]
        for template, slots in self.slots.items():
            at = _hash(template)
            for k, filler in slots.items():
                low, high = (-1, 1) if filler is True else (_hash(filler),) * 2
                rows.append(("slot", at ^ k, None, None, None, None, None, None, None, None, low, high))
        self.words, self.slots = {}, {}
        return rows


def judged_segments(
    units: DataFrame, id_col: str = "unit_id", columns: tuple[str, ...] = ("title", "text"), law: str | None = None
) -> DataFrame:
    """hash, whole, records, template, kind, certainty, name, residue of every
    distinct segment that shows something, after alignment with all others."""
    spark = units.sparkSession
    known = spark.sparkContext.broadcast(frozenset(anchors(units, columns)))
    distinct = (
        unit_segments(units, id_col, columns, law)
        .groupBy("segment", "whole")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.col("is_text").cast("long")).alias("texts"),
            (F.min("law") != F.max("law")).alias("unlike"),
        )
        .select(F.xxhash64("segment").alias("hash"), "segment", "whole", "records", "texts", "unlike")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(known.value)
        for batch in batches:
            out = []
            for key, segment, whole, records, texts, unlike in zip(*(c.to_pylist() for c in batch.columns)):
                words = _WORD.findall(segment.lower())
                found = judge(segment, whole)
                template, free = aligner.places(segment.split())
                weak = any(c == 1 and k == "slot" for _, k, c, _ in found)
                slots = [_hash(template) ^ k for k in free] if weak and template else None
                aligner.see(segment.split(), bool(found), template, free)
                out += [("found", key, whole, records, *f, slots, None, None, None) for f in found]
                if whole and unlike and texts >= PAGE_LEAST and words:
                    if not any(f[2] == 2 for f in found) and not _EDITED.match(segment):
                        out.append(("page", key, whole, records, skeleton(segment), None, None, None, None, words, None, None))
                elif not any(f[2] == 2 for f in found):
                    aligner.read(words, records)
            if len(aligner.words) + len(aligner.slots) > HELD:
                out += aligner.hand_on()
            yield _rows(out)
        yield _rows(aligner.hand_on())

    # what shows something, the words and the slots; read several times from here on
    seen = durable(distinct.mapInArrow(run, _FOUND))
    found = seen.where("tag = 'found'")
    names = found.where("kind = 'slot' and certainty = 2 and name is not null").select("name").distinct().withColumn("known", F.lit(True))
    induced = (
        seen.where("tag = 'slot'").groupBy("hash").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high").select(F.col("hash").alias("slot"))
    )
    retained = (
        found.where("kind = 'slot' and certainty = 1").select("hash", "whole", F.explode("slots").alias("slot"))
        .join(induced, "slot").select("hash", "whole").distinct().withColumn("induced", F.lit(True))
    )
    repeated = found.groupBy("template", "kind").agg(F.sum("records").alias("all_records"))
    evidence = (
        found.join(names, "name", "left").join(retained, ["hash", "whole"], "left").join(repeated, ["template", "kind"])
        .withColumn(
            "residue",
            (F.col("certainty") == 2)
            | ((F.col("kind") == "slot") & (F.coalesce("known", F.lit(False)) | F.coalesce("induced", F.lit(False))))
            | (F.col("kind").isin("message", "default") & (F.col("all_records") >= REPEATED)),
        )
        .select("hash", "whole", "records", "template", "kind", "certainty", "name", "residue")
    )
    running = seen.where("tag = 'word'").select(F.col("name").alias("word")).distinct()
    pairs = running.select(F.explode(_pairs(F.col("word"))).alias("pair")).distinct().withColumn("in_text", F.lit(True))
    page_words = (
        seen.where("tag = 'page'").select("hash", "records", "template", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
        .join(running, "word", "left_anti")
    )
    # compounds of words that laws use are no foreign words
    foreign = (
        page_words.withColumn("pair", F.explode_outer(_pairs(F.col("word")))).join(pairs, "pair", "left")
        .groupBy("hash", "records", "template", "size", "at")
        .agg(F.avg(F.col("in_text").isNull().cast("int")).alias("share"))
        .where("share >= 0.5")
    )
    pages = (
        foreign.groupBy("hash", "records", "template", "size")
        .agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"))
        .where((F.col("n") >= PAGE_FOREIGN * F.col("size")) & (F.col("last") == F.col("size") - 1))
        # running text has to be the rule and the page the exception
        .join(F.broadcast(seen.where("tag = 'word'").agg(F.sum("records").alias("read"))), F.col("read") > F.col("records") * F.col("size"))
        # a page's wording counts as a part of a value as well
        .select("hash", F.explode(F.array(F.lit(True), F.lit(False))).alias("whole"), "records", "template", F.lit("page").alias("kind"),
                F.lit(1).alias("certainty"), F.lit(None).cast("string").alias("name"), F.lit(True).alias("residue"))
    )
    return evidence.unionByName(pages)


def templates(judged: DataFrame) -> DataFrame:
    """template, kind, records, certainty, names, residue: what was induced, by template."""
    return judged.groupBy("template", "kind").agg(
        F.sum("records").alias("records"),
        F.max("certainty").alias("certainty"),
        F.array_sort(F.collect_set("name")).alias("names"),
        F.max("residue").alias("residue"),
    )


def residue_units(
    units: DataFrame, id_col: str = "unit_id", columns: tuple[str, ...] = ("title", "text"), law: str | None = None
) -> DataFrame:
    """id, kinds: the units with residue in one of the columns."""
    judged = durable(judged_segments(units, id_col, columns, law).where("residue").select("hash", "whole", "kind").distinct())
    flagged = judged.groupBy("hash", "whole").agg(F.collect_set("kind").alias("kinds"))
    if judged.count() <= BROADCAST_ROWS:
        flagged = F.broadcast(flagged)
    rows = unit_segments(units, id_col, columns, law).select("id", F.xxhash64("segment").alias("hash"), "whole")
    return (
        rows.join(flagged, ["hash", "whole"])
        .groupBy("id")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))).alias("kinds"))
        .withColumnRenamed("id", id_col)
    )


def clean_units(
    units: DataFrame, id_col: str = "unit_id", columns: tuple[str, ...] = ("title", "text"), law: str | None = None
) -> DataFrame:
    """The units without residue, all columns kept."""
    return units.join(residue_units(units, id_col, columns, law).select(id_col), id_col, "left_anti")
