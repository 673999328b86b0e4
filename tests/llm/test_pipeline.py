"""The pipeline against what each stage should do, by brute force on small tables."""

import os
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from plinth.llm import common

BASE = "the quick brown fox jumps over the lazy dog near the river bank and sleeps there until the morning comes again with light"
STAGES = dict(corpus_pipeline.STAGES)
#: Names that the stages or their operators use within, or might.
CLASHING = "wanted long, copied string, again int, plinth_lang string, lang_pred string, score double, bin_id string, copy string, words string, size int, nth int, kept boolean, row string, digest string, of string, n int, text_sha256 string, component_id long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters(text):
    return any(c.isalpha() for c in text or "")


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text):
    w = words((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def first_of(rows, groups):
    """Of each group the first row: ids before none, then the least."""
    kept = []
    for group in groups:
        kept.append(min(group, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)))
    return kept


def near_groups(rows, percent):
    sets = [shingles(r[1]) for r in rows]
    groups = []
    for i, s in enumerate(sets):
        near = [g for g in groups if s and any(sets[j] and 100 * len(s & sets[j]) >= percent * len(s | sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [[i, *(j for g in near for j in g)]]
    return groups


def made(spark, rows):
    n = len(CLASHING.split(","))
    return spark.createDataFrame([(*r, "en", s, k, *[None] * n) for k, (*r, s) in enumerate(rows)], f"{DOCS}, {CLASHING}")


def seen(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


ODD = [
    (1, "alpha " + BASE, "a"), (2, "beta " + BASE.upper(), "a"), (4, "gamma one two three", "b"), (5, "delta four five six", None), (5, "gamma one two three", "a"),
    (5, "gamma  one two three", "a"), (None, "delta four five six", "b"), (None, "epsilon seven", "b"), (None, "epsilon seven", "b"), (6, None, "a"), (7, "", None), (8, " \n", "a"),
    (9, "12 ½ ² ① !!", "a"), (10, "x" * 200_000, "a"), (11, "zeta " * 60_000, "b"), (-1, "eta theta", "b"), (12, BASE + " alpha", "a"), (3, "delta four five six", "a"),
]


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_odd_rows(spark, name):
    docs = made(spark, ODD)
    got = STAGES[name](spark, docs, "")
    rows = [r[:2] for r in ODD]
    if name == "packing":
        assert Counter(r["doc_id"] for r in got.collect() if r["piece"] == 0) == Counter(i for i, _ in rows)
    else:
        assert got.columns == docs.columns
    if name == "language_id":
        assert Counter(seen(got)) == Counter(r for r in rows if letters(r[1]))
    if name == "exact_dedup":
        groups = {}
        for k, (_, text) in enumerate(rows):
            groups.setdefault(squeezed(text), []).append(k)
        kept = first_of(rows, groups.values())
        assert sorted(seen(got), key=str) == sorted((rows[k] for k in kept), key=str)
    if name == "near_dedup":
        # texts without words are in no group; a row that repeats an id and text stays once
        kept = {(rows[k][0], squeezed(rows[k][1])) for k in first_of(rows, near_groups(rows, 80))}
        assert Counter((i, squeezed(t)) for i, t in seen(got)) == Counter(kept)
    if name == "mixing":
        assert {t for _, t in seen(got)} <= {t for _, t in rows if words(t)} and max(Counter(r["n_chars"] for r in got.collect()).values()) <= 2


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_empty_tables(spark, name):
    docs = made(spark, ODD).limit(0)
    got = STAGES[name](spark, docs, "")
    assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)


def test_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(400)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 60))), f"s{i % 4}"))
    rows += [(200 + i, rows[i][1].replace(" ", "\n "), "s1") for i in range(10)] + [(300 + i, rows[i][1] + " end", "s2") for i in range(5, 30)] + [(400, "12 34", "s0"), (401, None, "s0")]
    spark.createDataFrame([(*r, "en", s, 1) for *r, s in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    rows = [r for r in rows if letters(r[1])]
    equal = {}
    for k, r in enumerate(rows):
        equal.setdefault(squeezed(r[1]), []).append(k)
    rows = [rows[k] for k in first_of(rows, equal.values())]
    rows = [rows[k] for k in first_of(rows, near_groups(rows, 80))]
    size = {i: len(words(t)) for i, t, _ in rows}
    # targets: 150 % of all words by weight 5, 2, 1, 5; no source above twice its own
    own = Counter()
    for i, _, s in rows:
        own[s] += size[i]
    weight, share, target = dict(zip(sorted(own), (5, 2, 1, 5), strict=True)), 1.5 * sum(own.values()), {}
    while True:
        level = (share - sum(target.values())) / max(1e-9, sum(w for s, w in weight.items() if s not in target))
        over = [s for s, w in weight.items() if s not in target and level * w > 2 * own[s]]
        if not over:
            break
        target |= {s: 2 * own[s] for s in over}
    target |= {s: level * w for s, w in weight.items() if s not in target}
    assert set(got.doc_id) <= set(size) and got[got.piece == 0].groupby("doc_id").size().max() <= 2
    of = {i: s for i, _, s in rows}
    reached = got.groupby(got.doc_id.map(of)).length.sum()
    assert all(abs(reached[s] - target[s]) <= 60 for s in own), (reached, target)
    assert not got.assign(s=got.doc_id.map(of)).duplicated(["bin_id", "s"]).any() and (got.groupby("bin_id").length.sum() <= 2048).all()
    for (_, first), g in got[got.piece == 0].groupby(["doc_id", "first_word"]):
        assert first == 0 and (g.length == size[int(g.doc_id.iloc[0])]).all()


def test_near_copies_from_four_fifths_on_go(spark):
    words = [f"w{i}" for i in range(44)]  # 40 shingles; n more words give a similarity of 40 / (40 + n)
    texts = {1: words, 2: [*words, *(f"x{i}" for i in range(10))]}
    texts |= {3: [f"v{w}" for w in words], 4: [*(f"v{w}" for w in words), *(f"y{i}" for i in range(8))]}
    texts |= {5: [f"u{w}" for w in words], 6: [*(f"u{w}" for w in words), *(f"z{i}" for i in range(11))]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3, 5, 6]


def test_run_leaves_no_tables_of_stages(spark, tmp_path, monkeypatch):
    for module in (corpus_pipeline, common):
        monkeypatch.setattr(module, "shared_dir", lambda spark: str(tmp_path))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.filter("bin_id is not null").count() > 100
    assert len(list(tmp_path.iterdir())) == 1  # the result


def test_a_local_session_without_a_shared_folder_gets_one(monkeypatch):
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("Context", (), {"master": "local[2]"})

    path = common.shared_dir(Session)
    assert path == common.shared_dir(Session) and os.path.isdir(path)
    Session.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)
