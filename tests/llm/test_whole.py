"""Places where an operator once did less than its whole job."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tests.llm import brute
from zonalis.llm import decontamination, quality_rules, toxicity


def lexicon_rows(words: dict[str, int], least: int = 1) -> list[tuple[str, int, float]]:
    """What reaches ``chosen_entries``: all prefixes of the words with their documents, most first."""
    times: Counter[str] = Counter()
    for word, t in words.items():
        for n in range(toxicity.STEM, len(word) + 1):
            times[word[:n]] += t
    return [(e, t, 5.0) for e, t in sorted(times.items(), key=lambda x: (-x[1], x[0])) if t >= least]


def test_terms_with_slips_spread_over_their_letters_stay() -> None:
    slips = ["worthlss", "worhtless", "wortless", "worthlesd", "worthkess", "worthlwss"]
    assert "worthless" in toxicity.chosen_entries(lexicon_rows({"worthless": 920, **dict.fromkeys(slips, 13)}, 20), 500)
    slips = {"disgustinf": 15, "disgustng": 15, "disguating": 15, "disgistng": 15, "dishusting": 10}
    assert "disgusting" in toxicity.chosen_entries(lexicon_rows({"disgusting": 930, **slips}, 20), 500)


def test_every_candidate_is_stood_for() -> None:
    rng = random.Random(13)
    for _ in range(200):
        words = {"".join(rng.choices("ab", k=rng.randint(4, 12))): int(rng.paretovariate(0.5)) for _ in range(rng.randint(1, 40))}
        rows = lexicon_rows(words)
        seen = {e: t for e, t, _ in rows}
        terms = toxicity.chosen_entries(rows, 10_000)
        for e, t in seen.items():
            begun = any(e[:n] in terms for n in range(toxicity.STEM, len(e) + 1))
            assert begun or any(k.startswith(e) and seen[k] >= 0.95 * t for k in terms), (e, words)


def test_edits_at_the_first_letter_and_in_stems(spark: SparkSession) -> None:
    terms = {"idiot": 5.0, "disgusting": 5.0, "scum": 5.0}
    words = ["diot", "udiot", "diiot", "iidiot", "isgusting", "idoits", "dsigustingly", "idiots", "idiomatic", "sucm"]
    df = spark.createDataFrame([(f"such a {w} again",) for w in words], "text string").coalesce(1)
    found = [any(r[0]) for r in df.select(toxicity._features(terms)(F.col("text"))).collect()]
    assert found == [True] * 8 + [False] * 2


def test_rare_short_and_many_terms_are_learned(spark: SparkSession) -> None:
    """1,200 toxic texts of 12,000; a term of ten texts is less than a hundredth of them."""
    rng = random.Random(15)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    many = sorted({letters(9) for _ in range(600)})
    rows = [[f"plain text number {letters(7)}", int(i < 1200)] for i in range(12_000)]
    for term in ("rarest", "yob", *many):
        for i in rng.sample(range(1200), 10):
            rows[i][0] += " " + term
    rows += [[f"plain copied passage of {letters(6)} words"[:20], 1]] * 50
    terms = toxicity.learn_lexicon(spark.createDataFrame(rows, "_text string, _toxic int"), "_text")
    assert "yob" in terms and "passage" not in terms and not any("copied".startswith(t) for t in terms)
    assert all(any(w.startswith(t) for t in terms) for w in ("rarest", *many))
    matcher = toxicity.Matcher({"yob": 5.0}, anywhere=True)
    assert matcher.match("Yob!") == ("yob", 0) and matcher.match("yobbish") is None


def test_matcher_finds_edits_at_every_letter() -> None:
    rng = random.Random(14)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))

    def begins(w: str, t: str) -> list[int]:
        """Edits of the beginnings of ``w`` in which the last letter of the term is."""
        ends = [brute.edits(w[: i - 1], t[:-1]) for i in range(1, len(w) + 1) if w[i - 1] == t[-1]]
        return ends + [1 + brute.edits(w[: i - 2], t[:-2]) for i in range(2, len(w) + 1) if w[i - 2 : i] == t[-1] + t[-2]]

    for _ in range(30):
        terms = {word(rng.randint(4, 10)): 1.0 for _ in range(6)}
        matcher = toxicity.Matcher(terms, anywhere=True)
        for _ in range(150):
            w = list(rng.choice([*terms, word(7)]))
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randint(0, 1)] = rng.choice(["a", "b", "", "c"])
            w = "".join(w)[:14]
            options = [e for t in terms for e in [brute.edits(w, t), *begins(w, t)] if w and e <= toxicity.allowed(t)]
            found = matcher.match(w)
            assert (None if found is None else found[1]) == min(options, default=None), (w, terms)


def test_items_in_another_order_are_found(spark: SparkSession) -> None:
    rng = random.Random(16)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate([60, 80, 120, 200])]
    docs = []
    for i, text in items:
        w = text.split()
        for k, moved in enumerate((w[len(w) // 4 :] + w[: len(w) // 4], w[len(w) // 2 :] + w[: len(w) // 2], w)):
            clean = [f"c{rng.randrange(10**6)}" for _ in range(400)]
            docs.append((10 * i + k, " ".join(clean[:150] + moved + clean[150:])))
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = brute.leaks(docs, items)
    assert {(r["id"], r["item"]): r["similarity"] for r in found.collect()} == pytest.approx(expected) and len(expected) == 12


def test_more_than_twelve_patterns_and_four_conditions() -> None:
    rng = np.random.default_rng(17)
    values = {f"v{i:02}": rng.random(40_000) for i in range(16)}
    bad = np.logical_or.reduce([v > 0.98 for v in values.values()])
    said = np.zeros(len(bad), bool)
    for rule in quality_rules.learn(values, bad, rng.random(len(bad))):
        said |= quality_rules.covers(rule, values)
    assert (said == bad).mean() > 0.98
    values = {f"v{i}": rng.random(40_000) for i in range(6)}
    bad = np.logical_and.reduce([v > 0.3 for v in values.values()])
    rules = quality_rules.learn(values, bad, rng.random(len(bad)))
    assert len(rules[0]) > 4
