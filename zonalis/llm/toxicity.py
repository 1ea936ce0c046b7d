"""Toxicity scores from a learned lexicon, found through misspellings, and the context of each hit.

Lexicon: words and word stems (prefixes of 4 to 24 letters, so a longer word is entered by its first 24) whose documents are
toxic far more often than others, counted over all labelled rows that are not held out; shorter words are entries that match
themselves only.
Texts that are equal, with equal labels, count once. A stem that is as telling as its longer forms stands for them.
Entries need evidence, whatever the number of documents: their share of toxic texts must be so far from that of all texts
that less than one word is expected to get there by chance (Chernoff's bound, ``NEW_WORDS`` words for each text); where labels
are too few for that, a word in the share ``ENOUGH`` of the toxic texts and in no other has enough of it. There
is no limit on the number of entries; all of them are sent to the driver and to the tasks.

Matching: the lexicon is a trie, and a Levenshtein automaton walks along it: a state is a set of (trie node, edits so
far). States are made when a word first needs them and kept, so that the intersection of automaton and trie becomes
a deterministic automaton, and a word costs one step for each letter until its state is empty. A stem matches words
that begin with it; a word of five letters or more is also found with one edit, of nine or more with two, at any letter.
With edits, too, an entry may begin a longer word, if the entry's last letter is there ('idoits', but not 'idiom...').
Swapped neighbours count as one edit, digits and signs that stand for letters are read as the letters first. Words that
match with edits only, but are mostly seen in texts that are not toxic ('crown' for 'clown'), are look-alikes and no hits;
they come from the same counts, and their number is bounded by what resembles the lexicon.

Context: each hit is looked at in a window of words on both sides. Quotation marks around it, an opening mark before
it on the line, or words of reporting near by make it quotation; other hits near by make it abuse. Each edit takes the
share ``1 - SLIP`` off a hit. Sums of both kinds, the densest window, the sum per word and that of distinct terms are the features of a
logistic model whose weights are not negative, so that a hit, misspelled or not, never makes a text look cleaner. It is fitted
on at most ``max_rows`` labelled rows that are not held out, chosen by the hash of the id.

A document with several labels is toxic if one says so; NULL labels are ignored. Without labels of both kinds every
score is 0; so it is with empty tables. Long texts are scored whole, in portions of a batch. NULL and empty texts have no hits and get the score of such texts. Repeated rows get equal scores. Columns
of the input are kept; one with the name of a result is replaced. The score reads nothing but the text.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, portions, with_fields
from zonalis.sources.stage import staged

STEM, LONGEST = 4, 24
MIN_DOCS = 3  # toxic texts a lexicon entry is seen in at least
MIN_ODDS = 3.0  # log odds of an entry
NEW_WORDS = 100  # no more distinct words than this for each labelled text are expected
ENOUGH = 0.25  # a word in this share of the toxic texts, and in no other, has evidence enough however few there are
BROADCAST_LABELS = 1_000_000  # up to so many labelled documents are sent to all tasks, beyond that they are joined
MAX_ROWS = 50_000
WINDOW = 6  # words on each side of a hit
STATES, ITEMS, REMEMBERED = 50_000, 1_000_000, 300_000  # of the automaton, the items of its states, and words
FEATURES = 5
SLIP = 0.6  # what is left of a hit after each edit
ALIKE_DOCS, ALIKE_SHARE = 2, 0.5  # a look-alike is seen in so many texts that are not toxic, and its toxic share is below
TRIM = ".,;:!?\"'()[]{}<>«»“”„‘’…-–—*_~`"
READ_AS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
LETTERS = re.compile(r"[^\W\d_]*")
OPENS, CLOSES = set("\"“„«‘"), set("\"”“»’")
REPORTING = frozenset("said says wrote writes quote quoted quotes called calls dit disait écrit sagte sagt schrieb dijo dice escribió".split())


def allowed(term: str) -> int:
    """Edits at which a word still counts as the term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """Lexicon trie and Levenshtein automaton, made deterministic step by step.

    With ``anywhere``, edits may be at the first letter, and a term is found with edits at the beginning of a longer word
    too, if its last letter is there; otherwise edits come after the first letter and in whole words only.
    """

    def __init__(self, terms: dict[str, float], anywhere: bool = False, alike: frozenset[str] = frozenset()) -> None:
        self.weight = terms
        self.alike = alike
        self.anywhere = anywhere
        self.child: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.edits = [0]  # the most edits any term below a node allows
        for t in sorted(terms):
            node = 0
            for c in t:
                self.edits[node] = max(self.edits[node], allowed(t))
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.edits.append(0)
                node = self.child[node][c]
            self.edits[node] = max(self.edits[node], allowed(t))
            self.term[node] = t
        self.words: dict[str, tuple[str, int] | None] = {}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.members: list[tuple] = []
        self.step: list[dict[str, int]] = []
        self.whole: list[tuple | None] = []  # best term if the word ends in a state, and if it goes on
        self.begun: list[tuple | None] = []
        self.held = 0
        self.start = self._state({(0, 0, -1): 0}, [])

    def _best(self, items: Iterable[tuple[int, int, int]], most: int, least: int = 0) -> tuple[int, int, str] | None:
        """Fewest edits, then longest, then first of the terms, of ``least`` letters or more, that end in one of the items."""
        ends = [(e, t) for node, e, owed in items if owed < 0 and e <= most and (t := self.term[node]) is not None and len(t) >= least]
        return min(((e, -len(t), t) for e, t in ends if e <= allowed(t)), default=None)

    def _state(self, found: dict[tuple[int, int, int], int], exact: list[tuple[int, int, int]]) -> int:
        """Number of a state. Items are (node, edits, owed): ``owed`` is the node that a swapped pair still leads to.

        ``exact`` has the items whose last letter was just read.
        """
        open_ = list(found)
        items = set(open_)
        while open_:  # leave out letters of the term
            node, e, owed = open_.pop()
            if (node or self.anywhere) and owed < 0 and e < self.edits[node]:
                for below in self.child[node].values():
                    item = (below, e + 1, -1)
                    if e + 1 <= self.edits[below] and item not in items:
                        items.add(item)
                        open_.append(item)
        begun = self._best(exact, 2 if self.anywhere else 0, STEM)
        key = (begun, *sorted(items))
        if key not in self.number:
            self.number[key] = len(self.members)
            self.members.append(key[1:])
            self.step.append({})
            self.whole.append(self._best(items, 2))
            self.begun.append(begun)
            self.held += len(items)
        return self.number[key]

    def _next(self, state: int, c: str) -> int:
        found: dict[tuple[int, int, int], int] = {}
        exact: list[tuple[int, int, int]] = []
        for node, e, owed in self.members[state]:
            if owed >= 0:
                target, letter = divmod(owed, 0x110000)
                if chr(letter) == c:  # the second letter of a swapped pair
                    found[target, e, -1] = 0
                    exact.append((target, e, -1))
                continue
            same = self.child[node].get(c)
            if same is not None and e <= self.edits[same]:
                found[same, e, -1] = 0
                exact.append((same, e, -1))
            if (node or self.anywhere) and e < self.edits[node]:
                found[node, e + 1, -1] = 0  # a letter too many
                for letter, below in self.child[node].items():
                    if e + 1 <= self.edits[below]:
                        found[below, e + 1, -1] = 0  # another letter
                    swapped = self.child[below].get(c)
                    if swapped is not None and e + 1 <= self.edits[swapped]:
                        found[node, e + 1, swapped * 0x110000 + ord(letter)] = 0
        if not found:
            return -1
        return self._state(found, exact)

    def _walk(self, word: str) -> tuple[str, int] | None:
        if len(self.members) > STATES or self.held > ITEMS:
            self._forget()
        state = self.start
        best: tuple[int, int, str] | None = None
        for c in word:
            step = self.step[state].get(c)
            if step is None:
                step = self.step[state][c] = self._next(state, c)
            if step < 0:
                break
            state = step
            begun = self.begun[state]
            if begun is not None and (best is None or begun < best):
                best = begun
        else:
            whole = self.whole[state]
            if whole is not None and (best is None or whole < best):
                best = whole
        return None if best is None else (best[2], best[0])

    def match(self, word: str) -> tuple[str, int] | None:
        """The lexicon entry that a word stands for, and the number of edits; fewest edits, then longest, then first."""
        plain = word.lower().strip(TRIM)
        found = self._walk(plain) if plain else None
        if found is None and plain:
            read = plain.translate(READ_AS)
            if read != plain:
                found = self._walk(read)
                if found is not None:
                    found = (found[0], max(1, found[1]))
        if found is not None and found[1] and self.alike and (plain in self.alike or LETTERS.match(plain)[0] in self.alike):
            return None
        return found

    def look(self, word: str) -> tuple[str, int] | None:
        words = self.words
        if word in words:
            return words[word]
        if len(words) >= REMEMBERED:
            words.clear()
        found = words[word] = self.match(word)
        return found


def _quoted(words: list[str], i: int, line_open: bool) -> bool:
    if line_open:
        return True
    low, high = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
    opened = any(w[0] in OPENS for w in words[low : i + 1])
    closed = any(w.rstrip(".,;:!?")[-1:] in CLOSES for w in words[i:high])
    return (opened and closed) or any(w.lower().strip(TRIM) in REPORTING for w in words[low:high])


def features_of(text: str, matcher: Matcher) -> list[float]:
    """Weights of hits as abuse and as quotation, in the densest window, per word and of distinct terms, less for misspelled ones.

    A text with every term misspelled by one edit has at least ``SLIP`` times the features of the exact one.
    """
    words = text.split()
    look = matcher.look
    hits = [(i, m[0], SLIP ** m[1]) for i, m in enumerate(map(look, words)) if m is not None]
    if not hits:
        return [0.0] * FEATURES
    places = [i for i, _, _ in hits]
    opened = _open_at(words, places)
    sums = [0.0] * 2
    values = [matcher.weight[term] * share for _, term, share in hits]
    terms: dict[str, float] = {}
    densest = dense = 0.0
    low = 0
    for k, (i, term, _) in enumerate(hits):
        quote = _quoted(words, i, opened[k])
        sums[quote] += values[k]
        terms[term] = max(terms.get(term, 0.0), values[k])
        dense += values[k]
        while places[low] < i - WINDOW:
            dense -= values[low]
            low += 1
        if not quote:
            densest = max(densest, dense)
    return [*map(math.log1p, sums), math.log1p(densest), sum(values) / len(words), math.log1p(sum(terms.values()))]


def _open_at(words: list[str], places: list[int]) -> list[bool]:
    """Whether a long quotation, opened and later closed by double marks, holds each place."""
    marks = [(i, w) for i, w in enumerate(words) if w[0] in "“«„" or w.rstrip(".,;:!?")[-1:] in "”»"]
    if not marks:
        return [False] * len(places)
    spans, begin = [], None
    for i, w in marks:
        if w[0] in "“«„" and begin is None:
            begin = i
        if w.rstrip(".,;:!?")[-1:] in "”»" and begin is not None:
            spans.append((begin, i))
            begin = None
    starts = [s for s, _ in spans]
    at = np.searchsorted(starts, places, "right") - 1
    return [bool(k >= 0 and p <= spans[k][1]) for k, p in zip(at.tolist(), places, strict=True)]


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]
    weights: tuple[float, ...]  # bias first; empty if nothing could be learned
    alike: frozenset[str] = frozenset()  # words that resemble an entry but are at home in texts that are not toxic


def _training(labels: DataFrame, key: str, label: str) -> DataFrame:
    truth = labels.where(col(label).isNotNull() & col(key).isNotNull())
    truth = truth.groupBy(col(key).alias("_id")).agg(F.max(col(label)).alias("_toxic"))
    return truth.where(F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(5)) != 0)


@arrow_udf(T.ArrayType(T.StringType()))
def _distinct_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    letters = re.compile(r"[^\W\d_]+")
    kind = pa.list_(pa.string())
    for texts in batches:
        # Arrow holds the words of a portion in a small part of the room that they take as Python strings
        found = [pa.array([list(set(letters.findall((t or b"").decode().lower()))) for t in portion], kind) for portion in portions(texts)]
        yield pa.concat_arrays(found) if found else pa.array([], kind)


def word_counts(labelled: DataFrame, text: str) -> tuple[DataFrame, int, int]:
    """Toxic texts and all texts of each word, from rows with ``_toxic``, and of all words; equal texts count once."""
    texts = labelled.select((F.col("_toxic") > 0).cast("long").alias("t"), F.xxhash64(col(text)).alias("copy"), col(text).alias("text"))
    total = texts.select("t", "copy").distinct().agg(F.sum("t"), F.count("*")).first()
    words = texts.dropDuplicates(["t", "copy"]).select("t", F.explode(_distinct_words("text")).alias("word"))
    words = words.groupBy("word").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    return staged(words, "toxicity_words"), int(total[0] or 0), int(total[1])


def learn_lexicon(labelled: DataFrame, text: str, max_terms: int | None = None) -> dict[str, float]:
    """Entries and their weights (log odds) from rows with ``_toxic``; all of them, or the most frequent ``max_terms``."""
    return entries(*word_counts(labelled, text), max_terms)


def look_alikes(words: DataFrame, terms: dict[str, float]) -> frozenset[str]:
    """The counted words that match an entry with edits only and are mostly seen in texts that are not toxic."""

    @arrow_udf("boolean")
    def near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(terms, anywhere=True)
        for batch in batches:
            found = map(matcher.match, batch.to_pylist())
            yield pa.array([m is not None and m[1] > 0 for m in found], pa.bool_())

    clean = words.where((F.col("n") - F.col("t") >= ALIKE_DOCS) & (F.col("t") < ALIKE_SHARE * F.col("n")))
    return frozenset(r["word"] for r in clean.select("word", near("word").alias("near")).where("near").select("word").collect())


def entries(words: DataFrame, toxic: int, all_rows: int, max_terms: int | None = None) -> dict[str, float]:
    """Lexicon from counted words, summed over the words that share a prefix; both cover all rows."""
    if not toxic or toxic == all_rows:
        return {}
    cut = F.transform(F.sequence(F.lit(STEM), F.least(F.char_length("word"), F.lit(LONGEST))), lambda n: F.substring(F.col("word"), F.lit(1), n))
    cut = F.when(F.char_length("word") >= STEM, cut).otherwise(F.array("word"))
    counted = words.select("t", "n", F.explode(cut).alias("entry")).groupBy("entry").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    odds = F.log((F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5)) - math.log((toxic + 0.5) / (all_rows - toxic + 0.5))
    # log of the chance, at most, of so many toxic texts among n that are drawn from all
    clean = F.col("n") - F.col("t")
    share = F.col("t") * F.log(F.col("t") / F.col("n") / (toxic / all_rows))
    evidence = share + F.when(clean > 0, clean * F.log(clean / F.col("n") / (1 - toxic / all_rows))).otherwise(0.0)
    best = counted.where((F.col("t") >= MIN_DOCS) & (F.col("t") >= 0.8 * F.col("n"))).withColumn("odds", odds)
    # few labels cannot give much evidence: a term in a share of the toxic texts and in no other is always enough
    enough = min(math.log(NEW_WORDS * all_rows), ENOUGH * toxic * math.log(all_rows / toxic))
    best = best.where((F.col("odds") >= MIN_ODDS) & (evidence >= enough))
    rows = best.orderBy(F.desc("t"), "entry").select("entry", "t", "odds").collect()
    return chosen_entries([(r["entry"], r["t"], r["odds"]) for r in rows], max_terms)


def chosen_entries(rows: list[tuple[str, int, float]], max_terms: int | None = None) -> dict[str, float]:
    """A stem stands for its longer forms, but a longer form that makes up nearly all of a stem is taken instead.

    ``rows`` have the most documents first, so a stem comes before its longer forms. A longer form is left out only if
    an entry that was taken begins it; words shorter than a stem match themselves only and are all taken. Each step down
    from a stem may lose a few documents to slips; where these add up, so that no entry below a stem makes up nearly all
    of it, the stem is taken as well.
    """
    seen = {entry: t for entry, t, _ in rows}
    best_child: dict[str, int] = {}
    for entry, t in seen.items():
        best_child[entry[:-1]] = max(best_child.get(entry[:-1], 0), t)
    taken: set[str] = set()
    for entry, t, _ in rows:
        if len(entry) < STEM or best_child.get(entry, 0) < 0.95 * t and not any(entry[:n] in taken for n in range(STEM, len(entry))):
            taken.add(entry)
    below: dict[str, int] = {}  # documents of the most frequent entry that begins with a stem
    for entry in sorted(seen, key=len, reverse=True):
        kept = below.get(entry, 0)
        if entry not in taken and kept < 0.95 * seen[entry] and not any(entry[:n] in taken for n in range(STEM, len(entry))):
            taken.add(entry)
        below[entry] = max(kept, seen[entry] if entry in taken else 0)
        below[entry[:-1]] = max(below.get(entry[:-1], 0), below[entry])
    terms = [(entry, odds) for entry, _, odds in rows if entry in taken]
    return dict(terms[:max_terms])


@functools.lru_cache(maxsize=1)
def _matcher(terms: tuple[tuple[str, float], ...], alike: frozenset[str]) -> Matcher:
    """The matcher of a worker, kept with its states and words (both bounded) from one task to the next."""
    return Matcher(dict(terms), anywhere=True, alike=alike)


def _features(terms: dict[str, float], alike: frozenset[str] = frozenset()) -> Callable[[Column], Column]:
    @arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = _matcher(tuple(terms.items()), alike)
        for texts in batches:
            rows = [features_of((t or b"").decode(), matcher) for portion in portions(texts) for t in portion]
            ends = np.arange(len(rows) + 1, dtype=np.int32) * FEATURES
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.array(rows, float).ravel()))

    return run


def _newton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * 0.01
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_weights(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small penalty; bias first, then weights that are not negative.

    As long as a weight is negative, the feature with the most negative one is left out and the rest is fitted again.
    """
    x = np.column_stack([np.ones(len(x)), x])
    used = list(range(x.shape[1]))
    while True:
        w = _newton(x[:, used], y)
        if len(used) == 1 or w[1:].min() >= 0:
            break
        del used[1 + int(w[1:].argmin())]
    weights = np.zeros(x.shape[1])
    weights[used] = w
    return tuple(weights.tolist())


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", max_rows: int = MAX_ROWS
) -> Model:
    """Lexicon and weights from the labelled rows that are not held out."""
    truth = staged(_training(labels, key, label), "training_labels")
    if truth.count() <= BROADCAST_LABELS:
        truth = F.broadcast(truth)
    labelled = docs.select(col(key).alias("_key"), col(text).alias("_text")).join(truth, F.col("_key") == F.col("_id"))
    counted, toxic, all_rows = word_counts(labelled, "_text")
    terms = entries(counted, toxic, all_rows)
    if not terms:
        return Model({}, ())
    alike = look_alikes(counted, terms)
    sample = (
        labelled.select("_id", (F.col("_toxic") > 0).cast("int").alias("_y"), _features(terms, alike)(F.col("_text")).alias("_x"))
        .orderBy(F.xxhash64("_id"), "_x")
        .limit(max_rows)
        .select("_y", "_x")
        .toPandas()
    )
    return Model(terms, fit_weights(np.array(sample["_x"].tolist(), float), sample["_y"].to_numpy(float)), alike)


def score(df: DataFrame, model: Model, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), or under other names."""
    if not model.weights:
        value = F.lit(0.0)
    else:
        bias, *weights = model.weights
        found = F.transform(
            F.arrays_zip(_features(model.terms, model.alike)(F.coalesce(col(text), F.lit(""))).alias("x"), F.array(*map(F.lit, weights)).alias("w")),
            lambda p: p["x"] * p["w"],
        )
        value = F.aggregate(found, F.lit(bias), lambda a, b: a + b, lambda s: 1 / (1 + F.exp(-s)))
    scored = with_fields(df, F.struct(value.alias(score)), [score])
    return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
