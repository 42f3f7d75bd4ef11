"""Language identification by cross-parsing with suffix automata.

Per language, the letters of a bounded sample of labelled texts form one suffix automaton.
A text is parsed into phrases, each the longest match with anything in the sample from where
the last phrase ended, or a single letter that the sample lacks; a language that resembles the
text needs few phrases. Every phrase costs the bits it takes to point into the longest sample,
whatever the language, and a letter that the sample lacks those of naming it besides: a
language of which little is known is never cheaper for it. The sum is
divided by the letters of the text; the language with the least rate wins.

Texts are lowered and every run of other characters becomes one blank, as do both ends, so
that short texts match whole words. Whole texts are parsed: all pieces of ``SEGMENT``
characters of a batch walk through an automaton in step, one character at a time, as numpy
arrays, each as if a phrase began with it. Then every piece is walked again from the state in
which the piece before it ended, until both walks begin a phrase at the same letter; from there
on they are one. So the phrases are those of the text from its start, wherever pieces begin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.batches import raw, text_slices
from ledgerline.llm.names import free_names
from ledgerline.llm.shipping import ship_package

#: Bounds of the training sample of a language: texts, and characters of all of them. Texts are
#: taken whole or not at all; the first one always is.
SAMPLE_TEXTS, SAMPLE_CHARS = 200, 60_000
#: Ranges of hashes that are counted first (a power of two), so that only the lowest are ranked.
HASH_RANGES = 256
#: Longer texts are drawn only where a language has no others.
LONG_CHARS = 10_000
SEGMENT = 1024
#: Bytes up to which the steps of an automaton lie in a table of states and letters.
DENSE_BYTES = 64 << 20
UNKNOWN = "und"
#: A document is in no language that was learned if it needs over this share of the phrases
#: that its own letters need in random order (prose: 0.3 to 0.7 in alphabets, up to 0.85 in
#: Chinese by a small sample; random letters: about 1).
REJECT_SHARE = 0.9
#: Letters, at least, from which the phrases of the random order are counted.
CHANCE_CHARS = 1024
RUNS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def normalized(text: str) -> str:
    return f" {RUNS.sub(' ', text.lower()).strip()} "


@dataclass(frozen=True)
class Automaton:
    """Suffix automaton: next state by state and letter. State 0 is no match, and no letter
    leads on from it.

    ``own`` numbers the letters that the sample has by those of all samples, from 1 (0: none).
    The steps lie in a flat table, or as sorted keys if that would be too large: an alphabet
    of thousands of letters has few steps from each state."""

    own: np.ndarray
    n_letters: int
    n_chars: int
    table: np.ndarray | None
    keys: np.ndarray | None = None
    targets: np.ndarray | None = None

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Next states; ``letter`` in own numbers."""
        if self.table is not None:
            return self.table.take(state * np.int32(self.n_letters) + letter, mode="clip")
        key = state.astype(np.int64) * self.n_letters + letter
        at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], 0)


def suffix_automaton(numbers: np.ndarray, n_all: int) -> Automaton:
    """Automaton of a sequence of letter numbers below ``n_all``. State 1 is the start."""
    letters = np.unique(numbers)
    own = np.zeros(n_all, np.int32)
    own[letters] = np.arange(1, len(letters) + 1)
    n_letters, text = len(letters) + 1, own[numbers]
    follow: list[dict[int, int]] = [{}, {}]
    length, link = [0, 0], [0, 0]
    last = 1
    for letter in text.tolist():
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p and letter not in follow[p]:
            follow[p][letter] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = follow[p][letter]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and follow[p].get(letter) == q:
                    follow[p][letter] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    keys = np.array([s * n_letters + letter for s, steps in enumerate(follow) for letter in steps] or [0], np.int64)
    targets = np.array([t for steps in follow for t in steps.values()] or [0], np.int32)
    if 4 * len(follow) * n_letters <= DENSE_BYTES:
        table = np.zeros(len(follow) * n_letters, np.int32)
        table[keys] = targets
        return Automaton(own, n_letters, len(text), table)
    order = np.argsort(keys)
    return Automaton(own, n_letters, len(text), None, keys[order], targets[order])


def _walk(
    automaton: Automaton, letters: np.ndarray, lengths: np.ndarray, state: np.ndarray, begun: np.ndarray, met: np.ndarray | None = None
) -> np.ndarray:
    """Walk the columns of ``letters`` (longest first) from ``state``; the states at their ends.

    ``begun`` gets a mark where a phrase begins. With ``met`` (which columns go no further) a
    column stops where a phrase begins that ``begun`` has already: the rest is as marked."""
    start = automaton.step(np.ones(automaton.n_letters, np.int32), np.arange(automaton.n_letters, dtype=np.int32))
    # Columns that still run at step k are the first live[k].
    live = np.searchsorted(-lengths, -np.arange(len(letters)), side="left")
    for k in range(len(letters)):
        at = slice(0, live[k]) if met is None else np.flatnonzero(~met[: live[k]])
        if met is not None and not len(at):
            break
        letter = letters[k, at]
        new = automaton.step(state[at], letter)
        begins = new == 0
        if met is not None:
            met[at] = begins & begun[k, at]
        begun[k, at] = begins
        # A letter that the sample lacks is a phrase of its own: after it nothing is open.
        stuck = np.flatnonzero(begins)
        new[stuck] = start[letter[stuck]]
        state[at] = new
    return state


def _parse(automaton: Automaton, letters: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Number of phrases that begin in each column, parsed from the start of its text on.

    Columns are first walked as if a phrase began with them. Then each is walked from the state
    in which the one before it ended; if the walks have not met at its end, the column
    after it is walked once more."""
    begun = np.zeros(letters.shape, bool)
    end = _walk(automaton, letters, lengths, np.zeros(len(lengths), np.int32), begun)
    after = np.full(len(lengths), -1)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    again = np.flatnonzero(before >= 0)
    while len(again):
        marks, met = begun[:, again], np.zeros(len(again), bool)
        ended = _walk(automaton, letters[:, again], lengths[again], end[before[again]].copy(), marks, met)
        begun[:, again] = marks
        # Where walks met, the column ends as it did before.
        changed = again[~met & (ended != end[again])]
        end[again[~met]] = ended[~met]
        again = np.sort(after[changed][after[changed] >= 0])
    return begun.sum(axis=0)


class Model:
    """Automata of all languages over one alphabet; letters outside it match nothing."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        texts = {k: normalized(v) for k, v in samples.items()}
        self.letters = np.array(sorted({ord(c) for t in texts.values() for c in t}), np.uint32)
        n = len(self.letters) + 1  # the last number is "any other"
        self.automata = [suffix_automaton(self.numbered(texts[k]), n) for k in self.languages]
        #: Bits of a phrase, and of naming a letter that a sample lacks besides, the same for all
        #: languages: a phrase found in a sample is worth more than a letter found in none.
        self.phrase_bits = math.log2(max([2, *(a.n_chars for a in self.automata)]))
        self.letter_bits = math.log2(n + 1)

    def numbered(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(self.letters):
            return np.zeros(len(points), np.int32)
        at = np.searchsorted(self.letters, points).clip(max=len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, len(self.letters)).astype(np.int32)

    def phrases(self, texts: list[np.ndarray], languages: list[int] | None = None, segment: int = SEGMENT) -> np.ndarray:
        """Number of phrases by text and language (all, or those of the given numbers)."""
        automata = self.automata if languages is None else [self.automata[j] for j in languages]
        out = np.zeros((len(texts), len(automata)))
        pieces = [(i, at, t[at : at + segment]) for i, t in enumerate(texts) for at in range(0, len(t), segment)]
        if not pieces:
            return out
        # Longest first: those that still run at a step are the first columns.
        order = sorted(range(len(pieces)), key=lambda c: -len(pieces[c][2]))
        column = np.empty(len(pieces), np.int64)
        column[order] = np.arange(len(pieces))
        pieces_in_order = [pieces[c] for c in order]
        lengths = np.array([len(p) for *_, p in pieces_in_order])
        letters = np.zeros((int(lengths[0]), len(pieces)), np.int32)
        for c, (_, _, p) in enumerate(pieces_in_order):
            letters[: len(p), c] = p
        owner = np.array([i for i, *_ in pieces_in_order])
        # The piece before each one in its text (-1: none).
        before = np.full(len(pieces), -1)
        later = np.flatnonzero([at > 0 for _, at, _ in pieces])
        before[column[later]] = column[later - 1]
        for j, automaton in enumerate(automata):
            count = _parse(automaton, automaton.own[letters], lengths, before)
            out[:, j] = np.bincount(owner, weights=count, minlength=len(texts))
        return out

    def unmatched(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of letters that a sample lacks by text and language."""
        letters = np.concatenate([np.zeros(0, np.int32), *texts])
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        lacks = [a.own == 0 for a in self.automata]
        return np.stack([np.bincount(owner, weights=lack[letters], minlength=len(texts)) for lack in lacks], axis=1)

    def read(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Letter numbers of each text, and which texts have a letter."""
        has_letter = np.array([LETTER.search(t) is not None for t in texts], bool)
        return [self.numbered(normalized(t)) if h else np.zeros(0, np.int32) for t, h in zip(texts, has_letter)], has_letter

    def bits(self, numbered: list[np.ndarray], phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits, and letters that the sample lacks, by text and language."""
        unmatched = self.unmatched(numbered)
        return phrases * self.phrase_bits + unmatched * self.letter_bits, unmatched

    def rates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits per letter by text and language, those of the first phrase by text, and which
        texts have a letter."""
        numbered, has_letter = self.read(texts)
        n = np.array([max(1, len(t)) for t in numbered])
        bits, _ = self.bits(numbered, self.phrases(numbered))
        return bits / n[:, None], self.phrase_bits / n, has_letter

    def shares(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text in its language as a share of those that its letters need in
        random order, both without the first one and without letters that the sample lacks, which
        are phrases in any order; infinite for texts without a letter.

        A text is judged by its own letters, so neither the script nor the size of a sample
        matters. The order depends on nothing but the text; short texts are shuffled several
        times over."""
        numbered, has_letter = self.read(texts)
        phrases = self.phrases(numbered)
        bits, unmatched = self.bits(numbered, phrases)
        best = bits.argmin(axis=1)
        lacking = unmatched[np.arange(len(texts)), best]
        times = np.array([max(1, -(-CHANCE_CHARS // max(1, len(t)))) for t in numbered])
        chance = np.zeros(len(texts))
        for j in np.unique(best[has_letter]).tolist():
            at = np.flatnonzero(has_letter & (best == j))
            mixed = [np.random.default_rng(len(numbered[i])).permutation(np.tile(numbered[i], times[i])) for i in at]
            chance[at] = self.phrases(mixed, [j])[:, 0] / times[at] - lacking[at]
        own = phrases[np.arange(len(texts)), best] - lacking - 1
        # A text that is one phrase is in the sample as it stands.
        return np.where(has_letter, np.where(own > 0, own / np.maximum(chance - 1, 1e-9), 0.0), np.inf)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rate (bits per letter without the first phrase, which says
        nothing in a short text). The score is how much lower (0: not at all, towards 1) the
        winner needs than the next one; the first in the alphabet wins a tie."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        rates, first, known = self.rates(texts)
        best = rates.argmin(axis=1)
        ordered = np.sort(rates, axis=1)
        own = ordered[:, 0]
        second = ordered[:, 1] if len(self.languages) > 1 else np.maximum(own, math.log2(len(self.letters) + 2))
        score = np.where(known & (second > 0), 1 - own / np.where(second > 0, second, 1), 0.0)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, score, np.where(known, own - first, 0.0)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def drawn_texts(docs: DataFrame, label: str = "lang") -> DataFrame:
    """The sample as ``lang``, ``n`` (from 1) and ``text``, from rows with a label whose id is not
    held out (NULL ids are not used).

    It is bounded: per language the SAMPLE_TEXTS different texts whose hash is least,
    those over LONG_CHARS characters last, as far as they fit in SAMPLE_CHARS whole. Copies of
    a text count once. Only hashes are ranked, folded before their shuffle, and of these only the
    lowest ranges that hold enough, so neither a language nor a text with most of the rows is a
    burden."""
    able = docs.where((fold(F.col("doc_id")) != 0) & F.col(label).isNotNull() & F.col("text").isNotNull())
    n_chars = F.length("text")
    key = F.struct((n_chars > LONG_CHARS).alias("long"), F.xxhash64("text").alias("hash"), n_chars.alias("n_chars"))
    able = able.select(F.col(label).cast("string").alias("lang"), key.alias("key"), "text")
    # The top bits of a hash, signed, are in the order of the hash.
    at = {"long": F.col("key.long"), "range": F.shiftright("key.hash", 65 - HASH_RANGES.bit_length())}
    ranges = ["lang", *at]
    different = able.withColumns(at).select(*ranges, "key").distinct()
    below = Window.partitionBy("lang").orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    sizes = different.groupBy(*ranges).agg(F.count("*").alias("n_hashes"))
    sizes = sizes.withColumn("n_below", F.coalesce(F.sum("n_hashes").over(below), F.lit(0)))
    lowest = different.join(sizes.where(F.col("n_below") < SAMPLE_TEXTS), ranges, "left_semi")
    first = Window.partitionBy("lang").orderBy("key")
    drawn = lowest.select("lang", "key").withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_TEXTS)
    so_far = F.sum("key.n_chars").over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    drawn = drawn.withColumn("chars", so_far).where((F.col("chars") <= SAMPLE_CHARS) | (F.col("n") == 1))
    # At most SAMPLE_TEXTS hashes of a language, whose texts come to the driver anyway.
    return able.join(F.broadcast(drawn), ["lang", "key"]).groupBy("lang", "n").agg(F.min("text").alias("text"))


def train(docs: DataFrame, label: str = "lang") -> Model:
    """Learn from ``drawn_texts``; only these reach the driver. An empty table, or one without
    labels, teaches nothing."""
    samples: dict[str, list[str]] = {}
    for r in sorted(drawn_texts(docs, label).collect(), key=lambda r: (r["lang"], r["n"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    return Model({k: " ".join(v) for k, v in samples.items() if LETTER.search(" ".join(v))})


def predictor(model: Model, docs: DataFrame):
    """Column function: text to ``struct<lang_pred, score, rate>``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string, score:double, rate:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own: Model = shared.value
        for texts in text_slices(batches):
            names, *numbers = own.predict([t.decode() for t in raw(texts)])
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), *map(pa.array, numbers)], ["lang_pred", "score", "rate"])

    return predicted


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rate`` (bits per letter), which
    replace columns so named. Texts that are NULL or without a letter are ``und`` with score 0;
    so is everything if nothing was learned. Texts of any length are read whole."""
    (own,) = free_names(docs, "_found")
    found = docs.withColumn(own, predictor(model, docs)(F.col("text")))
    return found.withColumns({c: F.col(f"{own}.{c}") for c in ("lang_pred", "score", "rate")}).drop(own)


def _resembles(model: Model, docs: DataFrame, max_share: float):
    """Column function: whether a text is in one of the languages."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def resembles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own: Model = shared.value
        for texts in text_slices(batches):
            yield pa.array(own.shares([t.decode() for t in raw(texts)]) <= max_share)

    return resembles


def with_language(docs: DataFrame, model: Model, max_share: float = REJECT_SHARE) -> DataFrame:
    """Rows of ``docs`` in a language: with a letter, and with at most ``max_share`` of the
    phrases of the same letters in random order. A model that learned no language rejects
    nothing. NULL and empty texts go; repeated rows are judged alike; long texts are read
    whole; an empty table stays empty."""
    if not model.languages:
        return docs
    rows = docs.select(F.struct("*").alias("_row"), F.col("text"))
    return rows.where(_resembles(model, docs, max_share)(F.col("text"))).select("_row.*")
