r"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  A word's likelihood is the sum, over all its
segmentations into pieces, of the product of their probabilities (the forward algorithm); a text's is the product over
its words, a word being a maximal run of letters, lower-cased, with the vocabulary's word mark before it.

Training counts, over all training rows, the pieces into which the vocabulary's own tokenizer cuts each word.  The counts
are summed by Spark; what reaches the driver has at most one number for each piece and language.  A language is a non-null
``lang``; the number of languages is taken to be small (hundreds), the number of rows is not.

Prediction is a map over the rows and shuffles nothing.  Words of one length are scored together as arrays; a bounded
dictionary keeps the scores of words seen before.  Words over ``LONG`` letters run through the same recurrence one by one,
in time linear in their length.  Both ways rescale the sums of each language by themselves, so that no likelihood becomes 0,
whatever the word's length and however rare its letters.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text when nothing was learned;
equal likelihoods go to the language first in code point order; a null ``doc_id`` passes through (and is not held out);
rows repeat as they are; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwatch.llm.common import rekeyed, slices

MARK = "▁"
WORDS = re.compile(r"[^\W\d_]+")
LONG = 40
#: Letters between two rescalings of the arrays; a letter's least probability to the power of STEP + 1 is far from underflow.
STEP = 8
#: Words kept in a worker's dictionary at most.
KEPT = 300_000
#: Added to each count; a letter outside the vocabulary has the probability of a piece never seen, times UNKNOWN.
SMOOTH, UNKNOWN = 0.1, 0.01
#: Evidence of neighbouring words is not independent: log likelihood ratios are divided by this before they become a score.
TEMPER = 4.0


def vocabulary(path: str) -> tuple[bytes, list[str]]:
    """The tokenizer file's content and its pieces that are plain text, in order of their ids (others: empty)."""
    import sentencepiece

    with open(path, "rb") as f:
        proto = f.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    odd = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return proto, ["" if odd(i) else sp.id_to_piece(i) for i in range(sp.get_piece_size())]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def piece_counts(train: DataFrame, proto: bytes) -> DataFrame:
    """(lang, piece, n) over all rows of ``train`` (text, lang)."""
    shared = train.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        words: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            langs, pieces, ns = [], [], []
            for lang, own in words.items():
                found: Counter = Counter()
                for (_, n), ids in zip(own.items(), sp.encode(list(own), num_threads=1)):
                    for i in ids:
                        found[i] += n
                langs += [lang] * len(found)
                pieces += found.keys()
                ns += found.values()
            words.clear()
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.int32()), pa.array(ns, pa.int64())], ["lang", "piece", "n"])

        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words[lang].update(WORDS.findall(text.lower()))
            if sum(map(len, words.values())) > KEPT:
                yield from flush()
        yield from flush()

    rows = rekeyed(train, ("text", "lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    return rows.mapInArrow(run, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class PieceTable:
    """Ids of the pieces by a hash of their code points, looked up for many substrings at a time (open addressing)."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: dict[str, int]):
        self.bits = max(4, (8 * len(pieces)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.ids = np.full(1 << self.bits, -1, np.int64)
        with np.errstate(over="ignore"):
            for piece, i in pieces.items():
                h = np.uint64(0)
                for c in piece:
                    h = self.extend(h, np.uint64(ord(c)))
                slot = int(self._slot(h))
                while self.ids[slot] >= 0:
                    slot = (slot + 1) & (len(self.ids) - 1)
                self.keys[slot], self.ids[slot] = h, i

    def extend(self, h, code):  # type: ignore[no-untyped-def]
        return (h + code + np.uint64(1)) * self.BASE ^ (h >> np.uint64(29))

    def _slot(self, h):  # type: ignore[no-untyped-def]
        return ((h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)

    def find(self, h: np.ndarray, miss: int) -> np.ndarray:
        slot = self._slot(h).astype(np.int64)
        ids = self.ids[slot]
        open_ = np.flatnonzero((ids >= 0) & (self.keys[slot] != h))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.ids) - 1)
            ids[open_] = self.ids[slot[open_]]
            open_ = open_[(ids[open_] >= 0) & (self.keys[slot[open_]] != h[open_])]
        ids[ids < 0] = miss
        return ids


class Model:
    """Piece probabilities of each language; small and fixed in size by vocabulary and languages."""

    def __init__(self, langs: list[str], pieces: dict[str, int], probs: np.ndarray, unknown: np.ndarray):
        self.langs, self.pieces, self.probs, self.unknown = langs, pieces, probs, unknown
        self.table = PieceTable(pieces)
        self.longest = max(map(len, pieces), default=1)


def train(rows: DataFrame, path: str) -> Model:
    proto, names = vocabulary(path)
    counts = piece_counts(rows, proto).collect()  # at most pieces x languages
    langs = sorted({r.lang for r in counts})
    ids = {p: i for i, p in enumerate(names) if p}
    table = np.full((len(names), len(langs)), SMOOTH)
    at = {lang: k for k, lang in enumerate(langs)}
    for r in counts:
        table[r.piece, at[r.lang]] += r.n
    keep = np.fromiter(ids.values(), np.int64, len(ids))
    table = table[keep] / table[keep].sum(axis=0)
    return Model(langs, {p: k for k, p in enumerate(ids)}, table, table.min(axis=0) * UNKNOWN if langs else np.zeros(0))


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """Log likelihood of each word in each language, by the forward algorithm."""
    out = np.zeros((len(words), len(model.langs)))
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w)].append(i)
    probs = np.vstack([model.probs, np.zeros((1, len(model.langs))), model.unknown[None]])
    none, unknown = len(model.pieces), len(model.pieces) + 1
    table = model.table
    for n, group in by_length.items():
        marked = [MARK + words[i] for i in group]
        if n > LONG:
            for i, w in zip(group, marked):
                out[i] = _long_word(probs, model.pieces.get, none, unknown, model.longest, w)
            continue
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(group), n + 1).T.astype(np.uint64)
        sums = [np.ones((len(group), len(model.langs))), *[np.zeros((len(group), len(model.langs))) for _ in range(n + 1)]]
        scale = np.zeros((len(group), len(model.langs)))
        for a in range(n + 1):
            if a and a % STEP == 0:
                top = sums[a]
                scale += np.log(top)
                for end in range(n + 1, a - 1, -1):  # ends not reached yet hold 0
                    sums[end] = sums[end] / top
            h = np.zeros(len(group), np.uint64)
            for end in range(a + 1, min(a + model.longest, n + 1) + 1):
                h = table.extend(h, codes[end - 1])
                sums[end] += sums[a] * probs[table.find(h, unknown if end == a + 1 else none)]
        out[group] = np.log(sums[-1]) + scale
    return out


def _long_word(probs: np.ndarray, find, none: int, unknown: int, longest: int, w: str) -> np.ndarray:  # type: ignore[no-untyped-def]
    last = [np.ones(probs.shape[1])]  # the sums of the latest ``longest`` ends, divided by exp(scale)
    scale = np.zeros(probs.shape[1])
    for end in range(1, len(w) + 1):
        total = np.zeros(probs.shape[1])
        for a in range(max(0, end - longest), end):
            total += last[a - end] * probs[find(w[a:end], unknown if a == end - 1 else none)]
        last = [*last, total][-longest:]
        last, scale = [x / total for x in last], scale + np.log(total)
    return scale


class Scorer:
    """Languages and scores of texts, with a dictionary of the words seen before."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)))

    def _scored(self, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
        """The words of each text, and its log likelihood in each language."""
        found = [WORDS.findall((t or "").lower()) for t in texts] if self.model.langs else [[] for _ in texts]
        if len(self.rows) > KEPT:
            self.rows, self.scores = {}, self.scores[:0]
        new = list({w for words in found for w in words if w not in self.rows})
        for k in range(0, len(new), 50_000):
            part = new[k : k + 50_000]
            base = len(self.rows)
            self.rows.update(zip(part, range(base, base + len(part))))
            self.scores = np.vstack([self.scores, word_scores(self.model, part)])
        for words in found:
            yield words, self.scores[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))].sum(axis=0)

    def by_letter(self, texts: list[str | None]) -> list[float]:
        """The log likelihood of each text in its best language, for each of its letters (texts without one: minus infinity)."""
        return [float(total.max()) / sum(map(len, words)) if words else -np.inf for words, total in self._scored(texts)]

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, top = [], []
        for words, total in self._scored(texts):
            if not words:
                langs.append("und")
                top.append(0.0)
                continue
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            top.append(float(1 / np.exp((total - total[best]) / TEMPER).sum()))
        return langs, top


def predict(df: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1, the tempered posterior of ``lang_pred``) of each row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            langs, top = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(langs, pa.string()), pa.array(top, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rekeyed(df, ("doc_id", "text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def of_known_language(df: DataFrame, model: Model, letters: int) -> DataFrame:
    """The rows of ``df`` whose text a learned language explains better than letters drawn evenly from ``letters``, with all their columns.

    The rule is the same for any number of languages and any size of the sample: a posterior is high even for a text of none of them.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in batches:
            keep: list[bool] = []
            for part in slices([pa.RecordBatch.from_arrays([pa.array(batch, pa.string(), from_pandas=True)], ["text"])]):
                keep += [x > -np.log(letters) for x in scorer.by_letter(part.column("text").to_pylist())]
            yield pd.Series(keep)

    return df.where(told(F.col("`text`")))


def identify(df: DataFrame, path: str) -> DataFrame:
    """Learn from the rows that are not held out, predict all: ``doc_id, held_out, lang_pred, score``."""
    model = train(df.where(~held_out()), path)
    return predict(df, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
