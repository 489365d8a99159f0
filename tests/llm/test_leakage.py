import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeq.llm import leakage
from tests.conftest import rows
from tests.llm.test_canonical import plain

DOC = "doc_id long, text string, words string, at string, seed string"
ITEM = "item_id long, item_text string, words string"


def tables(spark, texts, items):
    return spark.createDataFrame([(i, t, "w", "a", "s") for i, t in enumerate(texts)], DOC), spark.createDataFrame([(i, t, "w") for i, t in enumerate(items)], ITEM)


def words(text):
    return re.findall(r"[^\W_]+", plain(text or "").lower())


def brute(texts, items, span=12):
    grams = {}
    for i, t in enumerate(items):
        w = words(t)
        for k in range(len(w) - span + 1):
            grams.setdefault(tuple(w[k : k + span]), set()).add(i)
    return {(d, i) for d, t in enumerate(texts) for w in [words(t)] for k in range(len(w) - span + 1) for i in grams.get(tuple(w[k : k + span]), ())}


def found(spark, texts, items):
    return {(r.doc_id, r.item_id): r for r in leakage.leaks(*tables(spark, texts, items)).collect()}


def test_against_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["Alpha", "beta", "Gámma", "12", "δ", "x9"]) + str(rng.randint(0, 40))
    items = [" ".join(word() for _ in range(rng.randint(5, 40))) for _ in range(12)]
    texts = []
    for _ in range(60):
        w = [word() for _ in range(rng.randint(0, 60))]
        src = rng.choice(items).split()
        n = rng.randint(8, 16)
        at = rng.randint(0, max(0, len(src) - n))
        k = rng.randint(0, len(w))
        texts.append(" -- ".join(w[:k]) + ", " + "\n".join(x.upper() for x in src[at : at + n]) + " " + " ".join(w[k:]))
    out = found(spark, texts, items)
    assert {k for k, r in out.items() if r.exact_words >= 12} == brute(texts, items) != set()


def test_disguise_and_substitution(spark):
    item = " ".join(f"word{n}" for n in range(20))
    broken = item.split()
    broken[6] = "other"
    texts = [item.replace("o", "о").replace(" ", " "), " ".join(broken[:13]), " ".join(item.split()[:11]), item + " " + item, "", None]
    out = found(spark, texts, [item, None, "", item])
    assert out[(0, 0)].exact_words == 20 and out[(0, 3)].exact_words == 20 and out[(3, 0)].exact_words == 20
    assert out[(1, 0)].exact_words < 12 and out[(1, 0)].overlap_words == 13 and out[(1, 0)].substituted_words == 1
    assert not any(d in (2, 4, 5) for d, _ in out) and not any(i in (1, 2) for _, i in out)


def test_every_single_substitution_is_seen(spark):
    base = [f"w{n}" for n in range(12)]
    texts = [" ".join(base[:k] + ["zzz"] + base[k + 1 :]) for k in range(12)]
    out = found(spark, texts, [" ".join(base)])
    assert {d for d, _ in out} == set(range(12)) and all(r.overlap_words == 12 for r in out.values())


def test_two_substitutions_hit_the_masks_for_two(spark):
    base = [f"w{n}" for n in range(12)]
    pairs = list(itertools.combinations(range(12), 2))
    texts = [" ".join("zzz" if n in pair else w for n, w in enumerate(base)) for pair in pairs]
    out = leakage.leaks(*tables(spark, texts, [" ".join(base)]), tolerance=2).collect()
    assert {r.doc_id for r in out} == set(range(66)) and all((r.overlap_words, r.substituted_words) == (12, 2) for r in out)
    exact = leakage.leaks(*tables(spark, [" ".join(base), texts[0]], [" ".join(base)]), tolerance=0).collect()
    assert [(r.doc_id, r.exact_words) for r in exact] == [(0, 12)]
    with pytest.raises(ValueError):
        leakage.masks(3)


def test_repeated_words_give_no_product_of_places(spark):
    docs, items = tables(spark, ["ha " * 20_000, "so " * 5000 + "ha " * 13], ["ha " * 300])
    worded = [leakage.with_words(docs, "doc_id", "text"), leakage.with_words(items, "item_id", "item_text")]
    assert leakage.hits(*worded).count() <= 3 * 20_013
    assert {r.doc_id: r.exact_words for r in leakage.leaks(docs, items).collect()} == {0: 300, 1: 13}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=12, max_size=40), st.lists(st.integers(0, 2), min_size=12, max_size=20), st.integers(0, 2))
def test_overlap_against_every_window(doc, item, tolerance):
    exact = best = 0
    for shift in range(-len(item), len(doc)):
        same = [item[i] == doc[i + shift] for i in range(len(item)) if 0 <= i + shift < len(doc)]
        if len(same) < 12:
            continue
        exact = max([exact, *(n for a in range(len(same)) for n in range(1, len(same) - a + 1) if all(same[a : a + n]))])
        starts = [a for a in range(len(same) - 11) if sum(not x for x in same[a : a + 12]) <= tolerance]
        best = max(best, len({i for a in starts for i in range(a, a + 12)}))
    got = leakage.overlap(np.array(doc), np.array(item), range(-len(item), len(doc)), tolerance)
    assert got[:2] == (exact, best)


def test_copies_long_texts_and_empty(spark):
    item = " ".join(f"q{n}" for n in range(12))
    long = "pad " * 60_000 + item
    assert {k for k, r in found(spark, [long, long, item], [item]).items() if r.exact_words >= 12} == {(0, 0), (1, 0), (2, 0)}
    assert found(spark, [], [item]) == {} and found(spark, [item], []) == {}


def test_shuffled_seeds_give_the_same(spark, monkeypatch):
    item = " ".join(f"q{n}" for n in range(14))
    before = set(found(spark, [item, "x"], [item]))
    monkeypatch.setattr(leakage, "MAX_BROADCAST_SEEDS", 0)
    monkeypatch.setattr(leakage, "MAX_BROADCAST_IDS", 0)
    assert set(found(spark, [item, "x"], [item])) == before == {(0, 0)}


def test_whole_table(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/eval_items.parquet")
    got = leakage.leaks(docs, items).filter("exact_words >= 12").select("doc_id", "item_id")
    ids, texts = zip(*[(r.doc_id, r.text) for r in docs.collect()])
    iids, itexts = zip(*[(r.item_id, r.item_text) for r in items.collect()])
    assert set(rows(got)) == {(ids[d], iids[i]) for d, i in brute(texts, itexts)}
