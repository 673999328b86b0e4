"""Captions: from the lines after an image to clean captions, references and the images of a group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plinth.functions import text as X

MOST_LINES, LONG_CHINESE, LONG = 3, 80, 160
# Phrases with which body text begins, as patterns and as words.
PHRASES = (
    r"\s+可纺丝溶胶的热失重", r"\s+TG曲线表明", r"\s+TG/DSC曲线表明", r"\s+曲线表明", r"\s+测试结果表明", r"\s+测试结果来看",
    r"\s+从测试结果来看", r"\s+测试发现", r"\s+随后", r"\s+经过精确控制", r"\s+结果表明", r"\s+将上述", r"\s+对所制", r"\s+此时",
    r"\s+经过", r"\s+从动摩擦系数", r"\s+[^,，。；;]{0,20}测试结果来看", r"\s+由图", r"\s+如图", r"\s+根据图", r"\s+从图",
    r"\s+图中可以看出", r"\s+可以看出", r"\s+可知", r"\s+表明", r"\s+显示", r"\s+说明", r"\s+如上图所示",
    r"数据见表\s*\d+(?:\.\d+)*", r"见表\s*\d+(?:\.\d+)*", r"\s+铝溶胶中含有", r"\s+根据[^,，。；;]{0,30}可知",
    r"\s+在进行[^,，。；;]{0,30}时", r"\s+结合", r"\s+这说明", r"\s+as shown", r"\s+the results show", r"\s+shows that",
    r"\s+indicates that",
)
STARTS = ("可纺丝溶胶的热失重", "TG曲线表明", "TG/DSC曲线表明", "曲线表明", "测试结果表明", "测试结果来看", "从测试结果来看", "从动摩擦系数测试结果来看", "铝溶胶中", "本文", "实验", "结果", "根据", "由", "如", "从", "在", "当", "为了", "通过", "结合", "可以", "因此", "这说明", "说明", "表明", "显示")
AFTER_STOP = r"(?iU)^\s*(?:由|如|根据|从|在|当|结果|the results|as shown)"
CHINESE = r"[\x{4e00}-\x{9fff}]"

DETAILS = "struct<caption:string,refs:array<string>,reason:string>"


def caption_lines(after: Column) -> Column:
    """Lines of a caption at the start of the text after an image; empty if the first text line starts none.

    One blank line may come first. The caption ends at a blank line, an image, a table, a heading, the references, or
    a line that does not continue it; it has MOST_LINES lines at most.
    """
    state = F.struct(F.lit(0).alias("blank"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        started = F.size(acc["out"]) > 0
        previous = F.element_at(acc["out"], -1)
        wall = line.rlike(X.IMAGE) | line.rlike(X.TABLE_START) | line.rlike(X.HEADING) | line.rlike(X.REFERENCES)
        english = previous.rlike(r"(?iU)^\s*(?:Fig\.?|Figure)\s*") & line.rlike(CHINESE)
        goes_on = ~line.rlike(X.BODY_REFERENCE) & (F.length(previous) < 100) & (F.length(line) <= 160) & ~english & ~previous.rlike(f"[{X.ENDS}]$")
        stop = acc["done"] | wall | F.when(line == "", started | (acc["blank"] >= 1)).when(~started, ~line.rlike(X.CAPTION_START)).otherwise(~goes_on)
        out = F.when(stop | (line == ""), acc["out"]).otherwise(F.concat(acc["out"], F.array(line)))
        return F.struct((acc["blank"] + (line == "").cast("int")).alias("blank"), (stop | (F.size(out) >= MOST_LINES)).alias("done"), out.alias("out"))

    return F.aggregate(F.transform(X.lines(after), X.compact), state, step)["out"]


def _before(text: Column, pattern: str) -> Column:
    """Start of the first match, null without one."""
    return F.when(text.rlike(pattern), F.length(F.element_at(F.split(text, pattern, 2), 1)))


def _other_figure(text: Column, number: Column) -> Column:
    """Start of the first other figure's id after the beginning, else of a shorthand such as ``, 3.2``."""
    spans = X.matches(text, X.ANY_ID)
    numbers = F.transform(spans, lambda x: F.regexp_extract(x["m"], rf"(?iU)({X.SNUM})\s*$", 1))
    others = F.filter(F.arrays_zip(spans.alias("x"), numbers.alias("n")), lambda z: (z["x"]["s"] > 0) & (z["n"] != number))
    shorthand = F.concat(F.lit(r"(?U)[、,，]\s*(?!"), X.escaped(number), F.lit(r"\b)\d+(?:[.\-]\d+)+"))
    short = F.when(F.regexp_like(text, shorthand), F.length(F.element_at(F.split(text, shorthand, 2), 1)))
    return F.when(number.isNotNull(), F.coalesce(F.get(others, F.lit(0))["x"]["s"], short))


def _repeated_figure(text: Column, number: Column) -> Column:
    """Start of a later mention of the same figure that opens a statement, with a preceding 根据, 由, 如 or 从."""
    own = X.escaped(number)
    says = F.concat(F.lit(r"(?iU)^(?:图\s*"), own, F.lit(r"\s*(?:为|是|显示|表明|可知)|(?:Fig\.?|Figure)\s*"), own, F.lit(r"\s+shows)"))
    found = []
    for word in (r"图\s*", r"Fig\.?\s*", r"Figure\s*"):
        pattern = F.concat(F.lit(rf"(?iU){word}"), own)
        parts = F.split(text, pattern, -1)
        hits = F.regexp_extract_all(text, pattern, F.lit(0))
        pairs = F.arrays_zip(F.slice(parts, 1, F.size(hits)).alias("a"), hits.alias("m"))
        state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            s = acc["at"] + F.length(x["a"])
            good = (acc["n"] > 0) & F.regexp_like(F.substring(text, s + 1, F.lit(80)), says)
            return F.struct((s + F.length(x["m"])).alias("at"), (acc["n"] + 1).alias("n"), F.coalesce(acc["out"], F.when(good, s)).alias("out"))

        found.append(F.aggregate(pairs, state, step)["out"])
    at = F.coalesce(*found)
    prefix = X.window(text, at - 4, at)
    return F.when(number.isNotNull(), at - F.when(prefix.endswith("根据"), 2).when(prefix.rlike("[由如从]$"), 1).otherwise(0))


def _phrase(text: Column) -> Column:
    """Start of the first phrase after the beginning. Those that follow white space are looked for at once: a compacted
    text begins with none, and the first match of all is the least of their first matches."""
    after_space = [p.removeprefix(r"\s+") for p in PHRASES if p.startswith(r"\s+")]
    patterns = [rf"\s+(?:{'|'.join(after_space)})", *(p for p in PHRASES if not p.startswith(r"\s+"))]
    starts = F.array(*[_before(text, f"(?iU){p}") for p in patterns])
    return F.array_min(F.filter(starts, lambda s: s > 0))


def _body_word(text: Column) -> Column:
    spaces = X.matches(text, rf"(?U)\s+(?=(?:{'|'.join(STARTS)}))")
    return F.get(F.filter(spaces, lambda x: x["s"] >= 12), F.lit(0))["s"]


def _after_stop(text: Column) -> Column:
    parts = F.split(text, X.SENTENCE_END, -1)
    state = F.struct(F.lit(0).alias("at"), F.lit(None).cast("int").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x)
        good = x.rlike(r"[。；;.]$") & F.substring(text, at + 1, F.lit(40)).rlike(AFTER_STOP)
        return F.struct(at.alias("at"), F.coalesce(acc["out"], F.when(good, at)).alias("out"))

    return F.aggregate(parts, state, step)["out"]


def caption_details(raw: Column, identifier: Column) -> Column:
    """Struct of the caption, the sentences that follow it, and why it was cut (null if whole)."""

    def cut(x: Column) -> Column:
        text, number = x["text"], x["number"]
        long = (F.length(F.regexp_replace(text, r"[^\x{4e00}-\x{9fff}]", "")) > LONG_CHINESE) | (F.length(text) > LONG)
        cuts = [(_other_figure(text, number), "multiple_figure_ids_in_caption"), (_repeated_figure(text, number), "repeated_figure_id"), (_phrase(text), "explanatory_phrase"), (_body_word(text), "space_body_start"), (F.when(long, _after_stop(text)), "length_guard")]
        first = F.get(F.filter(F.array(*[F.struct(at.alias("at"), F.lit(why).alias("why")) for at, why in cuts]), lambda c: c["at"].isNotNull()), F.lit(0))
        return F.struct(first.alias("cut"), text.alias("text"))

    named = X.let(X.compact(raw), lambda t: F.struct(t.alias("text"), F.coalesce(X.figure_number(identifier), X.figure_number(t)).alias("number")))
    return X.let(X.let(named, cut), _cut)


def _cut(x: Column) -> Column:
    at, text = x["cut"]["at"], x["text"]

    def following(rest: Column) -> Column:
        own = X.let(X.complete_sentences(rest), lambda f: F.when(F.size(f) == 0, F.array(rest)).otherwise(f))
        return F.when(rest == "", F.array().cast("array<string>")).otherwise(own)

    rest = F.when(at.isNull(), "").otherwise(F.trim(F.substring(text, at + 1, F.length(text))))
    return F.struct(F.when(at.isNull(), text).otherwise(F.trim(F.left(text, at))).alias("caption"), X.let(rest, following).alias("refs"), x["cut"]["why"].alias("reason"))


def segments(raw: Column) -> Column:
    """A caption with several figure ids, cut before each id but the first; empty pieces dropped."""

    def joined(parts: Column) -> Column:
        # what stands before the first id belongs to it
        lead = ~F.get(parts, F.lit(0)).rlike(X.ANY_ID) & (F.size(parts) > 1)
        return F.when(lead, F.concat(F.array(F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))), F.slice(parts, 3, F.size(parts)))).otherwise(parts)

    parts = F.split(X.compact(raw), r"(?=(?iU:图\s*\d|Fig\.?\s*S?\d|Figure\s*S?\d))", -1)
    return F.filter(F.transform(X.let(parts, joined), X.compact), lambda s: s != "")


def clean_references(sentences: Column, identifier: Column) -> Column:
    """The first three sentences that are not another figure's caption or a bare mention of it."""

    def own(s: Column) -> Column:
        other = X.let(X.figure_id(s)["id"], lambda i: i.isNotNull() & ~i.eqNullSafe(identifier))
        return ~(other & (s.rlike(X.CAPTION_START) | ~s.rlike(X.BODY_REFERENCE)))

    return F.slice(X.distinct_texts(F.filter(F.transform(sentences, X.compact), own)), 1, 3)


SEGMENT = ("id", "raw", "caption", "refs", "labels", "source", "raw_caption", "cleaned", "reason")


def caption_segments(raw: Column) -> Column:
    """Array of segments: figure id, caption, references, sub-figure labels and why it was cut."""

    def build(text: Column) -> Column:
        def cut(name: Column) -> Column:
            return F.struct(name.alias("name"), caption_details(text, F.coalesce(name["id"], name["raw"])).alias("d"))

        def row(x: Column) -> Column:
            name, d, caption = x["name"], x["d"], X.blank_to_null(x["d"]["caption"])
            values = (name["id"], name["raw"], caption, clean_references(d["refs"], name["id"]), X.labels(F.coalesce(caption, text)), F.when(caption.isNotNull(), "standard_caption").otherwise("none"), text, d["reason"].isNotNull(), d["reason"])
            return F.struct(*[v.alias(k) for k, v in zip(SEGMENT, values, strict=True)])

        return X.let(X.let(X.figure_id(text), cut), row)

    return F.transform(segments(raw), build)


def assignment(parts: Column, size: Column, index: Column) -> Column:
    """The segment of the index-th (from 1) of size images, with subfigure_index and subfigure_label.

    A single segment serves all images. Of several, each takes as many images as it has labels (one at least); the
    last serves what is left. If numbers do not match, all are marked uncertain.
    """
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<lo:int,hi:int,n:int,k:int>>").alias("out"), F.lit(False).alias("odd"))

    def step(acc: Column, p: Column) -> Column:
        wanted = F.greatest(F.size(p["labels"]), F.lit(1))
        n = F.least(wanted, size - acc["at"])
        row = F.struct(acc["at"].alias("lo"), (acc["at"] + n).alias("hi"), n.alias("n"), F.size(acc["out"]).alias("k"))
        return F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(row)).alias("out"), (acc["odd"] | (n != wanted)).alias("odd"))

    def place(p: Column) -> Column:
        single = F.size(p) == 1

        def of(d: Column) -> Column:
            own = F.get(F.filter(d["out"], lambda r: (r["lo"] < index) & (index <= r["hi"])), F.lit(0))
            odd = d["odd"] | (d["at"] < size)
            rest = F.struct((F.size(p) - 1).alias("k"), (size - d["at"]).alias("n"), (index - d["at"]).alias("i"), F.lit(True).alias("rest"), F.lit(True).alias("odd"))
            return X.let(own, lambda r: F.when(r.isNull(), rest).otherwise(F.struct(r["k"].alias("k"), r["n"].alias("n"), (index - r["lo"]).alias("i"), F.lit(False).alias("rest"), odd.alias("odd"))))

        whole = F.struct(F.lit(0).alias("k"), size.alias("n"), index.alias("i"), F.lit(False).alias("rest"), F.lit(False).alias("odd"))
        at = F.when(single, whole).otherwise(X.let(F.aggregate(p, state, step), of))
        return X.let(at, lambda a: F.struct(a.alias("a"), F.get(p, a["k"]).alias("seg")))

    def fill(x: Column) -> Column:
        a, seg = x["a"], x["seg"]
        fields = {name: seg[name] for name in SEGMENT}
        fields["cleaned"] = a["odd"] | seg["cleaned"]
        fields["reason"] = F.when(a["odd"], "multiple_figure_ids_caption_assignment_uncertain").otherwise(seg["reason"])
        fields["subfigure_index"] = F.when(a["n"] > 1, a["i"])
        fields["subfigure_label"] = F.when((F.size(seg["labels"]) == a["n"]) & ~a["rest"], F.get(seg["labels"], a["i"] - 1))
        return F.struct(*[v.alias(n) for n, v in fields.items()])

    return F.when(F.size(parts) > 0, X.let(X.let(parts, place), fill))
