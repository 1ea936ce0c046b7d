"""The methods inside the operators: guarantees, exactness and what happens to hot groups."""

from __future__ import annotations

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tests.llm import brute
from zonalis.llm import bpe, decontamination, quality_rules, sharding, simhash, substring_dedup, toxicity
from zonalis.llm.components import components
from zonalis.llm.queries import tokenizer


def test_encoder_as_the_library_on_random_text() -> None:
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_str(tokenizer()), bpe.vocabulary(tokenizer())
    rng = random.Random(3)
    kinds = ["abcdefgh", "aaab", "ab ", " \n\t\r\x0b\x0c", "0123456789 ", "'sdmtlrve ", "éèüßñ ", "日本語 한국어", "\U0001f600\U0001f3fd ", "  　\x85\x1c\x1f", "!?.,;<>|", "٣٤५६ "]
    for n in range(3000):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 60)))
        text = text.replace("<", "<|endoftext|>") if n % 50 == 0 else text
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert own.decode(np.array(ids, np.int64)).decode() == text


def test_compatible_pairs_are_what_merging_leaves() -> None:
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_str(tokenizer()), bpe.vocabulary(tokenizer())
    rng = random.Random(4)
    letters = [r for r in range(len(own.token)) if own.token[r].isalpha() and own.token[r].isascii()]
    for _ in range(3000):
        a, b = rng.choice(letters), rng.choice(letters)
        ids = library.encode((own.token[a] + own.token[b]).decode(), add_special_tokens=False).ids
        assert own.compatible(a, b) == (ids == [own.id_of[a], own.id_of[b]])


def test_unknown_ids_are_an_error() -> None:
    own = bpe.vocabulary(tokenizer())
    for bad in (-1, 60_000):
        with pytest.raises(ValueError):
            own.decode(np.array([bad]))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_in_the_radius(radius: int) -> None:
    masks = simhash.covering_masks(radius, list(range(64)))
    assert len(masks) == 2 ** (radius + 1) - 1
    for chosen in combinations(range(64), radius):
        flipped = sum(1 << b for b in chosen)
        assert any(not m & flipped for m in masks)


def test_masks_of_the_default_cover_random_pairs_and_keep_half() -> None:
    rng = random.Random(5)
    masks = simhash.covering_masks(4, list(range(64)))
    assert all(24 <= m.bit_count() <= 40 for m in masks)
    for _ in range(20_000):
        flipped = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & flipped for m in masks)


@pytest.mark.parametrize("limit", [4096, 3])
def test_links_connect_what_is_near(spark: SparkSession, limit: int) -> None:
    """Also when all buckets are over the limit and are dealt a second time."""
    rng = random.Random(6)
    centres = [rng.getrandbits(64) for _ in range(20)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(15)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), 4, limit).collect()
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 4 for r in found)
    parent = {p[0]: p[0] for p in signed}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        parent[root(r["a"])] = root(r["b"])
    expected = brute.linked(prints, 4)
    assert len({root(p[0]) for p in signed}) == len(set(expected))


def test_a_bucket_sends_less_links_than_members() -> None:
    members = np.unique(np.array([1 << b for b in range(60)] + [0, 1 << 62 | 1 << 61 | 3 << 58 | 7], np.int64))
    found = simhash.forest(members, 4)
    assert len(found) <= len(members) - 1 and len(found) >= 60


def test_components_of_chains_and_hubs(spark: SparkSession) -> None:
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame([*chain, *hub, (5, 5), (None, 3), (7, 6), (6, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**{i: 100 for i in range(101, 141)}, **{1000 + i: 1000 for i in range(1, 300)}, 7: 6}


@pytest.mark.parametrize("size", [1, 2, 3, 16, 17, 1000, 65_537])
def test_permutation_of_row_numbers(size: int) -> None:
    numbers = np.arange(size)
    there = sharding.permuted(numbers, size, 42)
    assert sorted(there.tolist()) == numbers.tolist()
    assert (sharding.permuted(there, size, 42, inverse=True) == numbers).all()
    if size > 100:
        assert (sharding.permuted(numbers, size, 43) != there).mean() > 0.9 and abs(np.corrcoef(numbers, there)[0, 1]) < 0.1


def test_rolling_hash_is_the_polynomial() -> None:
    rng = np.random.default_rng(7)
    values = rng.integers(0, 2**63, 200).astype(np.uint64)
    for size in (1, 2, 3, 7, 35, 64):
        found = substring_dedup.rolled(values, size, substring_dedup.BASES[0])
        base = int(substring_dedup.BASES[0])
        expected = [sum(int(values[i + j]) * pow(base, j, 2**64) for j in range(size)) % 2**64 for i in range(200 - size + 1)]
        assert found.tolist() == expected


def test_packed_cells_come_back() -> None:
    rng = np.random.default_rng(12)
    for n, top in ((0, 10), (1, 10), (5, 6), (1000, 1 << 20), (50, 1 << 20), (3, 256), (255, 255)):
        cells = np.sort(rng.choice(top, n, replace=False))
        assert (substring_dedup.unpacked(substring_dedup.packed(cells)) == cells).all()
    assert substring_dedup.unpacked(substring_dedup.packed(np.array([255, 510, 511]))).tolist() == [255, 510, 511]


def test_matcher_finds_what_edit_distance_finds() -> None:
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    for _ in range(30):
        terms = {word(rng.randint(4, 10)): 1.0 for _ in range(6)}
        matcher = toxicity.Matcher(terms)
        for _ in range(150):
            base = rng.choice([*terms, word(7)])
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randint(0, 1)] = rng.choice(["a", "b", "", "c"])
            w = "".join(w)[:14]
            options = [0 for t in terms if w.startswith(t)]
            options += [e for t in terms if w[:1] == t[0] and 0 < (e := brute.edits(w[1:], t[1:])) <= toxicity.allowed(t)]
            found = matcher.match(w)
            assert (None if found is None else found[1]) == min(options, default=None), (w, terms)


def test_misspelled_and_quoted_terms() -> None:
    matcher = toxicity.Matcher({"worthless": 5.0, "idiot": 5.0, "vequ": 5.0})
    assert matcher.match("Worhtless!") == ("worthless", 1) and matcher.match("w0rthless") == ("worthless", 1)
    assert matcher.match("1diot") == ("idiot", 1) and matcher.match("vequaire") == ("vequ", 0) and matcher.match("veqo") is None
    plain = toxicity.features_of("you are an idiot and I mean it", matcher)
    quoted = toxicity.features_of("the word “idiot” is what they said to them", matcher)
    assert plain[0] > 0 == plain[1] and quoted[1] > 0 == quoted[0]
    assert plain[2] > quoted[2]


def test_slips_raise_the_score(spark: SparkSession) -> None:
    """Terms with one slip each score above the clean text, with at least half of the exact form's log odds above it."""
    rng = random.Random(44)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    vocabulary = [letters(rng.randint(3, 9)) for _ in range(2000)] + ["crown", "crown", "truth"]
    terms = ["clown", "worthless", "trash", "idiot"]
    rows = []
    for i in range(1500):
        text = rng.choices(vocabulary, k=40) + ["crown"] * (i % 9 == 0)
        text += rng.choices(terms, k=rng.randint(1, 4)) if i % 10 == 0 else []
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1500)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert set(terms) <= set(model.terms) and "crown" in model.alike and min(model.weights[1:]) >= 0
    clean = " ".join(rng.choices(vocabulary, k=30))
    slips = {"clown": "clwon", "worthless": "worhtless", "trash": "trasj", "idiot": "idiiot"}
    texts = [clean, clean + " crown", *[f"{clean} {t}" for t in terms], *[f"{clean} {slips[t]}" for t in terms]]
    texts += [f"{clean} {' '.join(terms)}", f"{clean} {' '.join(slips.values())}"]
    scores = [r["score"] for r in toxicity.score(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), model).collect()]
    odds = [math.log(p / (1 - p)) for p in scores]
    assert odds[1] == pytest.approx(odds[0])
    for exact, slip in [*zip(odds[2:6], odds[6:10], strict=True), (odds[10], odds[11])]:
        assert exact > slip > odds[0] and slip - odds[0] >= 0.5 * (exact - odds[0])


def test_decision_list_learns_a_conjunction() -> None:
    rng = np.random.default_rng(9)
    values = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = ((values["a"] > 0.8) & (values["b"] < 0.5)) | (values["c"] > 0.95)
    rules = quality_rules.learn(values, bad, rng.random(3000))
    said = np.zeros(3000, bool)
    for rule in rules:
        said |= quality_rules.covers(rule, values)
    assert (said == bad).mean() > 0.97 and 2 <= len(rules) <= 6
    assert quality_rules.learn(values, np.zeros(3000, bool), rng.random(3000)) == []


def test_near_blocks_meet_within_the_radius(spark: SparkSession) -> None:
    rng = random.Random(10)
    rows = []
    for i in range(200):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << x for x in rng.sample(range(64), decontamination.RADIUS))
        rows.append((i, *(x - (1 << 64) if x >> 63 else x for x in (a, b))))
    df = spark.createDataFrame(rows, "i int, a long, b long")
    left = df.select("i", F.explode(decontamination._near_blocks(F.col("a"), 1)).alias("x"))
    right = df.select("i", F.explode(decontamination._near_blocks(F.col("b"), 2)).alias("x"))
    assert left.join(right, ["i", "x"]).select("i").distinct().count() == 200


def test_native_simhash_is_the_plain_one(spark: SparkSession) -> None:
    rng = random.Random(11)
    rows = [[rng.getrandbits(63) * rng.choice([1, -1]) for _ in range(n)] for n in (1, 2, 3, 17, 60)]
    found = spark.createDataFrame([(r,) for r in rows], "h array<long>").select(decontamination._simhash(F.col("h")).alias("s")).collect()
    for r, f in zip(rows, found, strict=True):
        expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r) > len(r))
        assert f["s"] & (2**64 - 1) == expected
