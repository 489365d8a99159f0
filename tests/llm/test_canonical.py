import random
import unicodedata as ud

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeq.llm import canonical
from tests.conftest import rows

DOC = "doc_id long, text string, form string, text_key string, piece string"


def plain(text):
    """Character by character, the whole text at once."""
    return None if text is None else ud.normalize("NFC", "".join(canonical.mapped(c) if ord(c) > 127 else c for c in text))


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "f", "k", "p") for i, t in enumerate(texts)], DOC)


TEXTS = [
    "plain", "", None, "ｆｕｌｌ　ｗｉｄｔｈ", "ﬁne ﬂow ﬀ", "été", "été", "ậ", "ậ", "ậ", "zero​width⁠﻿", "soft­hyphen", "no break thin",
    "non‑breaking", "РАУРАL", "ΑΒΕ", "ﾊﾞﾗ", "バラ", "バ", "한", "한", "²③½", "​", "e‍́", "́start", "line\nbreak", "x" * 200_000 + "́", "𝔸 𐐀́", "İ ẞ ß",
]


def test_forms_against_plain(spark):
    out = {r.doc_id: r.form for r in canonical.canonical_form(docs(spark, TEXTS)).collect()}
    assert out == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_random_texts(spark):
    rng = random.Random(1)
    pool = "ab e\n-" + "éậ한кО" + "̣́̂​ ‑ﬁｆﾊﾞᅡᆨᄀ²" + "".join(canonical.LOOKALIKES)
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    out = {r.doc_id: r.form for r in canonical.canonical_form(docs(spark, texts)).collect()}
    assert out == {i: plain(t) for i, t in enumerate(texts)}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=20))
def test_form_is_stable(text):
    assert plain(plain(text)) == plain(text)


def test_kept_apart():
    for a, b in ("Aa", "eé", "2²", "2②", "0O", "1l", "-–", "'’", "\n ", "ßs"):
        assert plain(a) != plain(b)
    assert plain("a  b") != plain("a b")


def test_pairs(spark):
    texts = ["same", "same", "sаme", "ｓame", "Same", "sa me", None, None, "", "​"]
    assert rows(canonical.lookalike_pairs(docs(spark, texts))) == sorted([(0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (8, 9)], key=repr)


def test_many_copies_and_one_variant(spark):
    """A third of all documents are copies of one text: candidates are pairs of texts, not of documents."""
    texts = ["copy"] * 3000 + ["сopy"] + [f"text {n}" for n in range(6000)]
    table = docs(spark, texts)
    assert rows(canonical.lookalike_pairs(table)) == sorted([(n, 3000) for n in range(3000)], key=repr)
    assert canonical.text_pairs(canonical._keyed_forms(table, "doc_id", "text")).count() == 1


def test_repeated_rows_and_empty(spark):
    twice = docs(spark, ["pаy"]).unionAll(docs(spark, ["pаy"])).unionAll(spark.createDataFrame([(5, "pay", "f", "k", "p")], DOC))
    assert rows(canonical.lookalike_pairs(twice)) == [(0, 5)]
    assert canonical.lookalike_pairs(docs(spark, [])).count() == 0
    assert rows(canonical.lookalike_classes(docs(spark, ["x", "х", None]))) == sorted([(0, 0, True), (1, 0, True), (2, None, None)], key=repr)


def test_whole_table(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    by_form = {}
    for i, t in texts.items():
        if t is not None:
            by_form.setdefault(plain(t), []).append(i)
    expected = {(a, b) for g in by_form.values() for a in g for b in g if a < b and texts[a] != texts[b]}
    assert set(rows(canonical.lookalike_pairs(table))) == expected
