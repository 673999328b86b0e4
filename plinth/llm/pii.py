"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Fixed patterns find the seed entities. The words around them are lexical patterns; patterns and the tokens that
stand in them form a graph whose scores are passed back and forth a few times, the seeds being certain. Patterns
that then stand for one kind with high confidence turn the other identifiers in them into findings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import hot_keys, joined, saved

KINDS = ("email", "ip", "card", "phone")
# Each pattern starts only where a run of its characters starts, or where the last match ended (\G), and is possessive
# where the next character cannot match anyway: the same matches, but no run is read again from each of its places.
PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a run of digits with single separators is one match of the base pattern; only runs of 14 to 19 can stay
    r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must hold for its pattern to be tried at all: every valid match of the pattern passes its gate.
GATES = ("@", r"[0-9]\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?+[0-9]){13}", r"\+[0-9]")
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)(?<=[0-9])"
#: Other identifiers, which only a pattern can turn into findings, and the shape that each kind asks of them.
OTHER = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++|[0-9](?<![A-Za-z0-9@._-][0-9])[0-9A-Za-z._/()-]{4,}[0-9A-Za-z]"
OTHER_GATE = r"@|[0-9][0-9A-Za-z._/()-]{4}"
SHAPES = (r"^.+@.+$", r"^[0-9]+(?:\.[0-9]+){2,5}$", r"^(?:[-./]?[0-9]){12,19}$", r"^(?:[-./()]*+[0-9]){7,15}$")
ROUNDS, CONFIDENCE, LEAST_SEEDS, DAMPING = 3, 0.75, 3, 1.0
#: Matches of a text are gone through in stretches of this many, so that no list grows by one item at a time for long.
STRETCH = 256
#: Tokens and patterns above this length stand in the graph by their digest.
NAME = 200
MATCH = "struct<s:int,e:int,m:string,l:string,l2:string,r:string>"
ENTITY = "struct<s:int,kind:int,e:int,m:string,l:string,l2:string,r:string>"
FIELDS = f"array<{MATCH}>"
WORD_BEFORE = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z"
WORDS_BEFORE = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z"
WORD_AFTER = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]+", "")


def _valid(kind: int, m: Column) -> Column:
    if kind == 1:
        return m.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == 2:
        return F.call_function("luhn_check", _digits(m))
    if kind == 3:
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def scanned(items: Column, state: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What a pass over items gives: step makes of the state and an item the next state and one output (of type out).

    The outputs of a stretch are gathered first and then the stretches, so the cost is n times the stretch at most.
    """
    empty = F.array().cast(f"array<{out}>")
    first = F.array(F.struct(state.alias("state"), empty.alias("out")))

    def one(acc: Column, x: Column) -> Column:
        after, value = step(acc["state"], x)
        return F.struct(after.alias("state"), F.concat(acc["out"], F.array(value)).alias("out"))

    def over(items: Column) -> Column:
        def stretch(acc: Column, at: Column) -> Column:
            before = F.struct(F.element_at(acc, -1)["state"].alias("state"), empty.alias("out"))
            return F.concat(acc, F.array(F.aggregate(F.slice(items, at, STRETCH), before, one)))

        starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(STRETCH))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(starts, first, stretch)

    # a transform over one value names it, so that the items are made once and not for each stretch
    return F.flatten(F.transform(F.element_at(F.transform(F.array(items), over), 1), lambda x: x["out"]))


def _around(before: Column, after: Column) -> list[Column]:
    words = [F.regexp_extract(before, WORD_BEFORE, 1), F.regexp_extract(before, WORDS_BEFORE, 1), F.regexp_extract(after, WORD_AFTER, 1)]
    return [F.lower(w).alias(name) for w, name in zip(words, ("l", "l2", "r"), strict=True)]


def found(text: Column, pattern: str, gate: Column) -> Column:
    """All matches: start, end (code points), match, the last word and the last two before it, and the first after it.

    Words reach back and forth to the next matches of the pattern.
    """
    matches, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    n = F.size(matches)
    rows = F.arrays_zip(F.slice(parts, 1, n).alias("a"), F.slice(parts, F.lit(2), n).alias("b"), matches.alias("m"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        s = at + F.length(x["a"])
        e = s + F.length(x["m"])
        return e, F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), *_around(x["a"], x["b"]))

    return F.when(gate, scanned(rows, F.lit(0), MATCH, step)).otherwise(F.array().cast(FIELDS))


def base_entities(docs: DataFrame) -> DataFrame:
    """doc_id, row, base (valid matches with their kind) and other (further identifiers outside of them)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    gates = [F.col("text").contains("@"), *(F.col("text").rlike(g) for g in GATES[1:])]
    rows = rows.select("doc_id", *[found(F.col("text"), p, g).alias(k) for k, p, g in zip(KINDS, PATTERNS, gates, strict=True)], found(F.col("text"), OTHER, F.col("text").rlike(OTHER_GATE)).alias("other"))
    return rows.withColumn("row", F.monotonically_increasing_id())


def _entity(x: Column, kind: int) -> Column:
    return F.struct(x["s"].alias("s"), F.lit(kind).alias("kind"), x["e"].alias("e"), *[x[c].alias(c) for c in ("m", "l", "l2", "r")])


def _labelled(kind: int) -> Column:
    return F.transform(F.filter(F.col(KINDS[kind]), lambda x: _valid(kind, x["m"])), lambda x: _entity(x, kind))


def outside(base: Column, other: Column) -> Column:
    """The items of other that overlap none of base: one pass up and one down over all of them by their starts."""
    marked = f"struct<x:{ENTITY},hit:boolean>"

    def up(end: Column, x: Column) -> tuple[Column, Column]:
        return F.when(x["kind"] >= 0, F.greatest(end, x["e"])).otherwise(end), F.struct(x.alias("x"), (end > x["s"]).alias("hit"))

    def down(start: Column, y: Column) -> tuple[Column, Column]:
        x = y["x"]
        return F.when(x["kind"] >= 0, x["s"]).otherwise(start), F.struct(x.alias("x"), (y["hit"] | (start < x["e"])).alias("hit"))

    passed = scanned(F.reverse(scanned(F.array_sort(F.concat(base, other)), F.lit(-1), marked, up)), F.lit((1 << 31) - 1), marked, down)
    free = F.transform(F.filter(passed, lambda y: (y["x"]["kind"] < 0) & ~y["hit"]), lambda y: y["x"])
    return F.when((F.size(base) > 0) & (F.size(other) > 0), free).otherwise(other)


def entities(docs: DataFrame) -> DataFrame:
    raw = saved(base_entities(docs))
    rows = raw.withColumn("base", F.array_sort(F.concat(*map(_labelled, range(len(KINDS)))))).drop(*KINDS)
    rows = rows.withColumn("other", F.transform("other", lambda x: _entity(x, -1)))
    return saved(rows.withColumn("other", outside(F.col("base"), F.col("other"))))


def _name(word: Column) -> Column:
    return F.when(F.length(word) <= NAME, word).otherwise(F.sha2(word, 256))


def in_patterns(rows: DataFrame) -> DataFrame:
    """row, s, e, kind, may, token, pattern: one row for each pattern that an entity or another identifier stands in.

    may holds the kinds that another identifier has the shape of.
    """
    one = rows.select("row", F.explode(F.concat("base", "other")).alias("x")).select("row", "x.*").withColumn("m", F.lower("m"))
    may = F.array_compact(F.array(*[F.when((F.col("kind") < 0) & F.col("m").rlike(shape), F.lit(k)) for k, shape in enumerate(SHAPES)]))
    around = F.when((F.col("l") != "") & (F.col("r") != ""), F.concat("l", F.lit(" _ "), "r"))
    before = F.when(F.col("l2") != "", F.concat(F.regexp_replace("l2", r"[\x20\x09-\x0D]+", " "), F.lit(" _")))
    places = one.select("row", "s", "e", "kind", may.alias("may"), _name(F.col("m")).alias("token"), F.explode(F.array_compact(F.array(around, before))).alias("pattern"))
    return places.withColumn("pattern", _name(F.col("pattern")))


def confident_patterns(places: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind: the patterns whose score for a kind reaches CONFIDENCE, with LEAST_SEEDS different seeds.

    A pattern's score is the mean score of the different tokens in it (damped); a token's is 1 if it is a seed of the
    kind, 0 if of another, else the mean of its patterns' scores. Only patterns with a seed take part.
    """
    edges = places.groupBy("pattern", "token").agg(F.max("kind").alias("kind"))
    enough = saved(edges.groupBy("pattern").agg(F.sum((F.col("kind") >= 0).cast("int")).alias("seeds")).filter(F.col("seeds") >= LEAST_SEEDS))
    edges = saved(joined(edges, enough, "pattern", hot_keys(edges, "pattern")))
    names = [f"k{k}" for k in range(len(KINDS))]
    seed = [(F.col("kind") == k).cast("double").alias(names[k]) for k in range(len(KINDS))]
    scored = edges.select("pattern", "token", "kind", *seed)
    free = edges.filter("kind < 0")
    hot_patterns, hot_tokens = hot_keys(free, "pattern"), hot_keys(free, "token")
    for _ in range(rounds):
        patterns = saved(scored.groupBy("pattern").agg(*[(F.sum(c) / (F.count(F.lit(1)) + DAMPING)).alias(c) for c in names]))
        back = saved(joined(free, patterns, "pattern", hot_patterns).groupBy("token").agg(*[F.avg(c).alias(c) for c in names]))
        guess = joined(free, back, "token", hot_tokens).select("pattern", "token", "kind", *names)
        scored = saved(edges.filter("kind >= 0").select("pattern", "token", "kind", *seed).unionByName(guess))
    best = scored.groupBy("pattern").agg(*[(F.sum(c) / (F.count(F.lit(1)) + DAMPING)).alias(c) for c in names], *[F.sum((F.col("kind") == k).cast("int")).alias(f"n{k}") for k in range(len(KINDS))])
    fits = F.array_compact(F.array(*[F.when((F.col(c) >= CONFIDENCE) & (F.col(f"n{k}") >= LEAST_SEEDS), F.lit(k)) for k, c in enumerate(names)]))
    return best.select("pattern", F.explode(fits).alias("kind"))


def _is(kind: int):
    return lambda x: x == kind


def _joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found: one row per row of docs.

    The counts and base_sha256 are of the base entities; spans has those that patterns add too (n_found of them),
    which never overlap base ones. A null text counts as empty and has no spans; repeated rows and null doc_ids are
    rows like others, and all take part in the scores. An empty table gives no rows. Columns other than doc_id and
    text are ignored.
    """
    rows = entities(docs)
    places = saved(in_patterns(rows))
    sure = saved(confident_patterns(places))
    open_ = places.filter("kind < 0 and size(may) > 0")
    more = joined(open_, sure.groupBy("pattern").agg(F.collect_list("kind").alias("of")), "pattern", hot_keys(open_, "pattern"))
    more = more.select("row", "s", "e", F.explode(F.array_intersect("may", "of")).alias("of"))
    more = more.groupBy("row", "s", "e").agg(F.min("of").alias("kind")).groupBy("row").agg(F.collect_list(F.struct("s", "kind", "e")).alias("more"))
    base = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))
    kept = rows.select("row", "doc_id", base.alias("base"))
    spans = kept.join(saved(more), "row", "left").withColumn("more", F.coalesce("more", F.array().cast("array<struct<s:int,kind:int,e:int>>")))
    counts = [F.size(F.filter(F.transform("base", lambda x: x["kind"]), _is(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.array_sort(F.concat("base", "more"))).alias("spans"), F.size("more").cast("long").alias("n_found"))
