"""Text functions as Column expressions; offsets are code points, as everywhere in plinth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that results depend on, in Java's dialect ((?U): Unicode classes).
NUM = r"\d+(?:[.\-]\d+)*"
SNUM = rf"S?{NUM}"
IMAGE = r"(?U)!\[([^\]]*)\]\(([^\n]*)\)"
FIGURE_ID = rf"(?iU)图\s*({NUM})|\bFig\.?\s*({SNUM})|\bFigure\s*({SNUM})"
ANY_ID = rf"(?iU)图\s*({NUM})|Fig\.?\s*({SNUM})|Figure\s*({SNUM})"
MENTION = rf"(?iU)图\s*({SNUM})|Fig\.?\s*({SNUM})|Figure\s*({SNUM})"
CAPTION_START = rf"(?iU)^\s*(?:图\s*{NUM}|Fig\.?\s*{SNUM}|Figure\s*{SNUM})\b"
TABLE_START = r"(?iU)^\s*(?:表\s*\d+(?:\.\d+)*|Table\s*\d+(?:\.\d+)*|\[TableID:)"
HEADING = r"(?mU)^\s{0,3}#{1,6}\s+(.+?)\s*$"
REFERENCES = r"(?iU)^\s*(?:references|bibliography|参考文献|致谢|学位论文评阅及答辩情况表)\b"
LABEL = r"(?U)[（(]\s*([A-Za-z][A-Za-z0-9_-]{0,20})\s*[）)]"
_PANEL = r"(?:\s*[（(][A-Za-z0-9]+[）)])?"
BODY_REFERENCE = "(?iU)" + "|".join([
    rf"图\s*{NUM}{_PANEL}\s*为", rf"[将由如]图\s*{NUM}", rf"根据图\s*{NUM}", rf"从图\s*{NUM}{_PANEL}\s*可以看出",
    rf"图\s*{NUM}{_PANEL}\s*(?:表明|显示)", r"见表\s*\d+", rf"shown in\s+(?:Fig\.?|Figure)\s*{SNUM}",
    rf"(?:Fig\.?|Figure)\s*{SNUM}{_PANEL}\s+(?:shows|indicates)",
])
PSEUDO_REFERENCE = r"(?iU)图\s*\d"
ENDS = "。；;？！!?."
# Ends of sentences: not a period between digits, nor after the abbreviations fig. eq. ref. al.
SENTENCE_END = r"(?U)(?<=[。；;？！!?])|(?<=\.)(?<!(?i:fig|ref)\.)(?<!(?i:al|eq)\.)(?<!\d\.(?=\d))"
TOKEN = r"[A-Za-z][A-Za-z0-9_-]{2,}|[0-9]+(?:[.\-][0-9]+)*|[\x{4e00}-\x{9fff}]{2,}"
CUES = ("如图", "由图", "见图", "根据图", "从图", "可知", "可见", "表明", "显示", "as shown", "shown in", "shows", "indicates")
LINES = r"\R|[\x1c-\x1e]"
LEAST_SENTENCE, LONGEST_DESCRIPTION = 8, 1000
HIT = "struct<s:int,e:int,m:string>"
#: Items of a pass that are gathered at once.
STRETCH = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compact(x: Column) -> Column:
    """White space runs as one space, trimmed; null as the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def blank_to_null(x: Column) -> Column:
    return F.when(x != "", x)


def scanned(items: Column, state: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What one pass over items gives: step makes of the state and an item the next state and one output (of type out).

    Outputs are gathered in stretches of STRETCH and the stretches then, so that no array grows item by item for long.
    """
    empty = F.array().cast(f"array<{out}>")
    first = F.array(F.struct(state.alias("state"), empty.alias("out")))

    def one(acc: Column, x: Column) -> Column:
        after, value = step(acc["state"], x)
        return F.struct(after.alias("state"), F.concat(acc["out"], F.array(value)).alias("out"))

    def over(all_: Column) -> Column:
        def stretch(acc: Column, at: Column) -> Column:
            start = F.struct(F.element_at(acc, -1)["state"].alias("state"), empty.alias("out"))
            return F.concat(acc, F.array(F.aggregate(F.slice(all_, at, STRETCH), start, one)))

        starts = F.when(F.size(all_) > 0, F.sequence(F.lit(1), F.size(all_), F.lit(STRETCH))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(starts, first, stretch)

    return F.flatten(F.transform(let(items, over), lambda x: x["out"]))


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern: start, end, match."""

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        s = at + F.length(x["a"])
        return s + F.length(x["m"]), F.struct(s.alias("s"), (s + F.length(x["m"])).alias("e"), x["m"].alias("m"))

    def walk(x: Column) -> Column:
        return scanned(F.arrays_zip(F.slice(x["parts"], 1, F.size(x["found"])).alias("a"), x["found"].alias("m")), F.lit(0), HIT, step)

    return let(_pieces(text, pattern), walk)


def _pieces(text: Column, pattern: str) -> Column:
    """Struct of all matches and of what lies before, between and after them."""
    return let(text, lambda t: F.struct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("found"), F.split(t, pattern, -1).alias("parts")))


def edited(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """The text with every match replaced by change(match)."""

    def join(x: Column) -> Column:
        new = F.concat(F.transform(x["found"], change), F.array(F.lit("")))
        return F.array_join(F.zip_with(x["parts"], new, lambda p, b: F.concat(p, b)), "")

    return let(_pieces(text, pattern), join)


def masked(text: Column, pattern: str) -> Column:
    """The text with every match replaced by as many spaces, so that offsets stay."""
    return edited(text, pattern, lambda m: F.repeat(F.lit(" "), F.length(m)))


def distinct_texts(texts: Column) -> Column:
    """Compacted, without empty ones, the first of equals kept in order."""
    return F.array_distinct(F.filter(F.transform(texts, compact), lambda t: t != ""))


def without_noise(text: Column) -> Column:
    """Images, inline code and links of Markdown as a space."""
    for pattern in (IMAGE, r"`[^`]*`", r"\[[^\]]+\]\([^)]+\)"):
        text = F.regexp_replace(text, pattern, " ")
    return text


def sentences(text: Column) -> Column:
    """Sentences of LEAST_SENTENCE characters and an unterminated tail: s, e, m (compacted)."""

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        e = at + F.length(x)
        return e, F.struct(at.alias("s"), e.alias("e"), compact(x).alias("m"))

    return F.filter(scanned(F.split(text, SENTENCE_END, -1), F.lit(0), HIT, step), lambda x: F.length(x["m"]) >= LEAST_SENTENCE)


def complete_sentences(text: Column) -> Column:
    """Terminated sentences of LEAST_SENTENCE characters, compacted."""
    done = let(F.split(without_noise(text), SENTENCE_END, -1), lambda c: F.slice(c, 1, F.size(c) - 1))
    return F.filter(F.transform(done, compact), lambda x: F.length(x) >= LEAST_SENTENCE)


def tokens(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), F.lower))


def labels(text: Column) -> Column:
    """Sub-figure labels in brackets, in order, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LABEL), F.lit(1)))


def figure_id(text: Column) -> Column:
    """Struct raw, id of the first figure id of a text; null fields if it has none."""

    def name(t: Column) -> Column:
        zh, fig, figure = (F.regexp_extract(t, FIGURE_ID, k) for k in (1, 2, 3))
        named = F.when(zh != "", F.concat(F.lit("图"), zh)).when(fig != "", F.concat(F.lit("Fig."), fig)).when(figure != "", F.concat(F.lit("Figure "), figure))
        return F.struct(blank_to_null(compact(t)).alias("raw"), named.alias("id"))

    # the match alone holds all groups; a word boundary before it is a given
    return let(F.regexp_extract(F.coalesce(text, F.lit("")), FIGURE_ID, 0), name)


def figure_number(text: Column) -> Column:
    return blank_to_null(F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?iU){SNUM}", 0))


def mentioned_numbers(text: Column) -> Column:
    """Numbers of all figures that a text mentions, lower case, each once."""
    groups = lambda t: F.concat(*[F.regexp_extract_all(t, F.lit(MENTION), F.lit(k)) for k in (1, 2, 3)])
    return F.array_distinct(F.transform(F.filter(let(F.coalesce(text, F.lit("")), groups), lambda x: x != ""), F.lower))


def escaped(x: Column) -> Column:
    return F.regexp_replace(x, r"([.\-])", r"\\$1")


def mentions(sentence: Column, identifier: Column) -> Column:
    """Whether a sentence mentions exactly this figure: its number, not followed by a digit, period or hyphen."""
    pattern = F.concat(F.lit(r"(?iU)(?:图|Fig\.?|Figure)\s*"), escaped(figure_number(identifier)), F.lit(r"(?![\d.\-])"))
    known = identifier.isNotNull() & ~identifier.startswith("Unknown Figure") & figure_number(identifier).isNotNull()
    return F.coalesce(known & F.regexp_like(sentence, pattern), F.lit(False))


def lines(text: Column) -> Column:
    return F.split(text, LINES, -1)


def window(text: Column, start: Column, end: Column) -> Column:
    """text[start:end], with start cut at 0."""
    start = F.greatest(start, F.lit(0))
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def pseudo_caption(identifier: Column, context: Column) -> Column:
    number = blank_to_null(F.regexp_extract(F.coalesce(identifier, F.lit("")), r"(?U)\d+(?:\.\d+)*", 0))
    known = identifier.isNotNull() & (identifier != "") & ~identifier.startswith("Unknown Figure")
    return F.when(known & context.rlike(PSEUDO_REFERENCE), F.concat(F.lit("图"), number, F.lit(" 相关测试结果图")))


def description(caption: Column, references: Column, identifier: Column, label: Column, fallback: Column | None = None, always_prefix: bool = False) -> Column:
    """Caption (with the figure's name and label) and references as one text, or the first sentences of fallback."""
    named = F.concat(identifier, F.lit("("), label, F.lit("): "), caption)
    plain = F.concat(identifier, F.lit(": "), caption) if always_prefix else caption
    first = F.when(F.coalesce(caption, F.lit("")) != "", F.when(F.coalesce(label, F.lit("")) != "", named).otherwise(plain))
    parts = F.filter(F.concat(F.array_compact(F.array(first)), references), lambda x: x != "")
    if fallback is not None:
        other = F.slice(complete_sentences(F.coalesce(fallback, F.lit(""))), 1, 2)
        parts = let(parts, lambda p: F.when(F.size(p) == 0, other).otherwise(p))
    return let(F.rtrim(F.left(F.array_join(distinct_texts(parts), " "), F.lit(LONGEST_DESCRIPTION))), blank_to_null)


def is_base64_image(x: Column) -> Column:
    """Whether a text decodes strictly and starts like a JPEG, PNG or GIF, or is longer than 50 bytes."""
    raw = F.try_to_binary(x, F.lit("base64"))
    head = F.hex(F.substring(raw, 1, 8))
    return F.coalesce(head.startswith("FFD8FF") | head.startswith("89504E470D0A1A0A") | head.startswith("47494638") | (F.octet_length(raw) > 50), F.lit(False))


def image_extension(x: Column) -> Column:
    head = F.hex(F.substring(F.try_to_binary(x, F.lit("base64")), 1, 12))
    return F.when(head.startswith("FFD8FF"), ".jpg").when(head.startswith("47494638"), ".gif").when(head.startswith("52494646") & head.endswith("57454250"), ".webp").when(head.startswith("424D"), ".bmp").otherwise(".png")


def data_uri_payload(x: Column) -> Column:
    return blank_to_null(F.regexp_extract(F.coalesce(x, F.lit("")), r"(?s)^data:image/[^;]+;base64,(.+)$", 1))


def image_hash(content: Column, base64_text: Column) -> Column:
    """sha256 of the bytes; of the decoded text where there are none. Characters outside of base64 are skipped."""
    decoded = F.try_to_binary(F.regexp_replace(base64_text, r"[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    return F.sha2(F.coalesce(content, decoded), 256)


def safe_data_id(x: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(x, r"[^A-Za-z0-9_.\-]", "_"), r"^[._-]+|[._-]+$", "")
    clean = F.coalesce(blank_to_null(clean), F.lit("paper"))
    return F.left(F.concat(F.left(clean, F.lit(110)), F.lit("-"), F.left(F.sha1(x.cast("binary")), F.lit(10))), F.lit(128))
