"""Language identification with a string kernel.

A text's features are which n-grams of one to three bytes it has (a blended spectrum, presence only), after
A-Z are lower-cased and digits, punctuation and white space become one separator. N-grams are hashed into
SPACE columns; two that share a column count as one, which makes kernels of unlike texts a little larger.
The kernel of two texts is the number of columns that both have over the geometric mean of the numbers that
each has. It is approximated by Nyström with landmark texts, and one-versus-rest kernel ridge regression is
fitted on that. Texts are scored in batches: presence matrix times landmarks, then times weights.

The classifier is fitted on a sample of bounded size: of each language the distinct (doc_id, text) of least
hash, as many of each as SAMPLE allows, one at least. No language is left out. Whole texts are classified.

Defined cases: null texts and texts without a letter are `und` with score 0, as is every text if nothing
could be learned (the pipeline then keeps all texts with a letter); they are not learned from. A null doc_id
is not held out and never learned from. Repeated rows are learned from once, and each gets its prediction.
More than MOST_LANGUAGES labels are an error. Very long texts are read whole, in pieces. Of languages with equal
scores the first by name is predicted. An empty table gives no rows. Further columns, whatever their names, are
not read by predict() and carried along by identified().
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.llm.words import raw_bytes
from walletgraph.shared import Table, received, send

#: Texts of the sample: for each language at most, and in all (more only if there are more languages).
PER_LANGUAGE, SAMPLE, MOST_LANGUAGES = 300, 2400, 10_000
#: Rows of a language that are ordered: so many times those wanted, and so many more; odds are e^-60 that none is among them.
OVERSAMPLE, SPARE = 4, 60
#: Columns that n-grams are hashed into.
SPACE = 1 << 15
LANDMARKS, RIDGE = 200, 1e-2
#: Of a text in a learned language, landmarks have at least this share of what they have of the sample's median text.
LEAST_KNOWN = 0.5
#: Usual columns of a language are those that this share of its sample has; only a language with so many texts in the sample has any.
COMMON, LEAST_TEXTS = 0.05, 20
#: Of a text's runs of three letters at least this share of what a language's median text has are usual in it; fewer runs than these tell nothing.
LEAST_USUAL, LEAST_RUNS = 1 / 3, 10
#: How sharply scores follow the margins between languages.
SHARPNESS = 4.0
BATCH, PIECE = 256, 1 << 20
UNKNOWN = "und"
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)
_LETTER = np.array([97 <= b <= 122 or 65 <= b <= 90 for b in range(256)])


def _grams(data: np.ndarray):
    """Codes of the n-grams of a text's bytes: the order in the top byte, piece by piece."""
    for lo in range(0, len(data), PIECE):
        one = _FOLD[data[lo : lo + PIECE + 2]]
        two = one[:-1] | one[1:] << np.uint32(8)
        three = two[:-1] | one[2:] << np.uint32(16)
        yield one | np.uint32(1 << 24), two | np.uint32(2 << 24), three | np.uint32(3 << 24)


def has_letter(data: np.ndarray) -> bool:
    return bool(_LETTER[data].any()) or bool((data >= 128).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "ignore"))


def columns(codes: np.ndarray) -> np.ndarray:
    return codes * np.uint32(0x9E3779B1) >> np.uint32(33 - SPACE.bit_length())


def letter_runs(data: np.ndarray):
    """Columns of all occurrences of three bytes that belong to letters, piece by piece."""
    for one, _, three in _grams(data):
        letter = (one & np.uint32(255)) != 32
        yield columns(three[letter[:-2] & letter[1:-1] & letter[2:]])


def fill(out: np.ndarray, data: np.ndarray) -> None:
    """Marks a text's columns."""
    for orders in _grams(data):
        for codes in orders:
            out[columns(codes)] = 1


class Model:
    """presence: a row of SPACE zeros and ones for each text of the sample; labels: their languages."""

    def __init__(self, presence: np.ndarray, labels: list[str]):
        self.labels = sorted(set(labels))
        y = np.array([[1.0 if label == x else -1.0 for x in self.labels] for label in labels])
        seen, nth = Counter(), []
        for x in labels:
            seen[x] += 1
            nth.append(seen[x])
        marks = presence[np.argsort(nth, kind="stable")[:LANDMARKS]]  # one of each language, again and again
        self.sizes = np.sqrt(np.maximum(marks.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
        self.used = np.flatnonzero(marks.any(axis=0))
        self.marks = np.packbits(marks[:, self.used], axis=1)  # a megabyte at most
        self.landmarks = None
        own = self.kernel(marks)
        values, vectors = np.linalg.eigh((own + own.T).astype(np.float64) / 2)
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        z = np.c_[self.kernel(presence) @ root, np.ones(len(presence))]
        w = np.linalg.solve(z.T @ z + RIDGE * np.eye(z.shape[1]), z.T @ y)
        rest = presence[np.argsort(nth, kind="stable")[LANDMARKS:]]
        self.least_known = LEAST_KNOWN * float(np.median(self.known(rest if len(rest) else marks)))
        self.weights, self.bias = (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)
        self.landmarks = None  # travels packed
        own = np.array(labels, dtype=object)
        many = {x: int((own == x).sum()) for x in self.labels}
        #: Of each language with enough texts its usual columns, 4 KB each, of SAMPLE / LEAST_TEXTS languages at most.
        self.usual = {x: np.packbits(presence[own == x].sum(axis=0, dtype=np.int32) >= COMMON * n) for x, n in many.items() if n >= LEAST_TEXTS}
        #: The least share of usual runs of letters, where measure() has set one.
        self.least_usual: dict[str, float] = {}

    def kernel(self, presence: np.ndarray) -> np.ndarray:
        if self.landmarks is None:
            self.landmarks = np.ascontiguousarray(np.unpackbits(self.marks, axis=1, count=len(self.used)).T, dtype=np.float32)
        out = np.empty((len(presence), len(self.sizes)), np.float32)
        for at in range(0, len(presence), BATCH):
            own = presence[at : at + BATCH]
            size = np.sqrt(np.maximum(own.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
            out[at : at + BATCH] = own[:, self.used].astype(np.float32) @ self.landmarks / size[:, None] / self.sizes[None, :]
        return out

    def known(self, presence: np.ndarray) -> np.ndarray:
        """The share of each text's columns that some landmark has."""
        return presence[:, self.used].sum(axis=1, dtype=np.int64) / np.maximum(presence.sum(axis=1, dtype=np.int64), 1)

    def usual_share(self, data: np.ndarray, label: str) -> float | None:
        """Of all runs of three letters in the text the share that is usual in the language; None if that can't be told. The share doesn't follow the text's length."""
        if label not in self.usual:
            return None
        usual, found, runs = np.unpackbits(self.usual[label]), 0, 0
        for own in letter_runs(data):
            found, runs = found + int(usual[own].sum()), runs + len(own)
        return found / runs if runs >= LEAST_RUNS else None

    def is_usual(self, data: np.ndarray, label: str) -> bool:
        """Whether runs of letters are usual in the language, or in another one, as texts of several languages have them."""
        if label not in self.least_usual:
            return True
        for x in (label, *(x for x in self.least_usual if x != label)):
            share = self.usual_share(data, x)
            if share is None or share >= self.least_usual[x]:
                return True
        return False

    def classify(self, presence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the language, its share of all, and how many times the next one's share that is."""
        margin = SHARPNESS * (self.kernel(presence) @ self.weights + self.bias)
        share = np.exp(margin - margin.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        top = share.argmax(axis=1)
        best = share[np.arange(len(top)), top].astype(np.float64)
        if share.shape[1] == 1:
            return top, best, np.full(len(top), np.inf)
        return top, best, best / np.maximum(np.partition(share, -2, axis=1)[:, -2], 1e-30)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, noise: bool = False) -> Model | None:
    """From labelled documents that are not held out; None if there are none.

    With noise=True the model also learns what share of a language's runs of letters is usual, by which identified() tells letters
    without a language: the sample's texts are written once and read again."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    own = Table(usable.select("doc_id", "lang", F.xxhash64("text").alias("print")).distinct(), "labelled")
    counts = own.df.groupBy("lang").agg(F.count("*").alias("many"))
    languages = counts.count()
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} labels are more than {MOST_LANGUAGES}")
    each = max(1, min(PER_LANGUAGE, SAMPLE // max(languages, 1)))
    # Some times as many as needed of each language, by hash, so that no language's rows meet in one task; then the least.
    turn = F.xxhash64("doc_id", "print")
    near = own.df.join(F.broadcast(counts), "lang").where(F.pmod(turn, F.lit(1 << 30).cast("long")).cast("double") * F.col("many") <= F.lit(float((OVERSAMPLE * each + SPARE) << 30)))
    order = Window.partitionBy("lang").orderBy(F.pmod(turn, F.lit(1 << 30).cast("long")), turn, "doc_id", "print")
    chosen = Table(near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each), "chosen")
    own.drop()
    wanted = chosen.df.drop("nth")

    def mark(batches):
        for batch in batches:
            data, offsets = raw_bytes(batch["text"])
            bits = []
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                row = np.zeros(SPACE, np.uint8)
                if has_letter(data[lo:hi]):
                    fill(row, data[lo:hi])
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["lang"], batch["print"], pa.array(bits, pa.binary())], ["doc_id", "lang", "print", "bits"])

    texts = usable.select("doc_id", "lang", F.xxhash64("text").alias("print"), "text").join(F.broadcast(wanted), ["doc_id", "lang", "print"], "left_semi")
    kind, held = docs.schema["doc_id"].dataType.simpleString(), None
    if noise:
        held = Table(texts, "sample")
        texts = held.df
    rows = texts.mapInArrow(mark, f"doc_id {kind}, lang string, print long, bits binary").dropDuplicates(["doc_id", "lang", "print"]).collect()  # 4 KB each
    chosen.drop()
    blank = bytes(SPACE // 8)
    rows = sorted((r for r in rows if r.bits != blank), key=lambda r: (r.lang, r.doc_id, r.print))
    model = Model(np.unpackbits(np.frombuffer(b"".join(r.bits for r in rows), np.uint8).reshape(len(rows), -1), axis=1), [r.lang for r in rows]) if rows else None
    if held:
        if model:
            measure(model, held.df)
        held.drop()
    return model


def measure(model: Model, sample: DataFrame) -> None:
    """Sets the least share of usual runs of each language by its texts of the sample."""
    sent = send(sample.sparkSession, model)

    def shares(batches):
        own = received(sent)
        for batch in batches:
            data, offsets = raw_bytes(batch["text"])
            found = [own.usual_share(data[lo:hi], x) for x, lo, hi in zip(batch["lang"].to_pylist(), offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(found, pa.float64())], ["lang", "share"])

    medians = sample.select("lang", "text").mapInArrow(shares, "lang string, share double").where("share is not null").groupBy("lang").agg(F.percentile("share", 0.5).alias("share"))
    model.least_usual = {r.lang: LEAST_USUAL * r.share for r in medians.collect()}  # as many as usual has


def _classifier(model: Model | None):
    """For the texts of a batch: predicted labels, scores, and how far each is ahead of the next; 0 for texts that are like none."""

    def run(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        data, offsets = raw_bytes(texts)
        labels, scores, ahead = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if model is None:
            return labels, scores, ahead
        for at in range(0, len(texts), BATCH):
            to = min(at + BATCH, len(texts))
            known = np.zeros((to - at, SPACE), np.uint8)
            ok = []
            for i in range(at, to):
                own = data[offsets[i] : offsets[i + 1]]
                if has_letter(own):
                    fill(known[i - at], own)
                    ok.append(i)
            if ok:
                top, share, more = model.classify(known[np.array(ok) - at])
                for i, t in zip(ok, top.tolist(), strict=True):
                    labels[i] = model.labels[t]
                scores[ok], ahead[ok] = share, np.where(model.known(known[np.array(ok) - at]) >= model.least_known, more, 0.0)
        return labels, scores, ahead

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    sent = send(docs.sparkSession, model)

    def run(batches):
        classify = _classifier(received(sent))
        for batch in batches:
            labels, scores, _ = classify(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(labels, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, model: Model | None, ahead: float) -> DataFrame:
    """The documents, all columns kept, that are in a learned language: it has at least `ahead` times the share of the next one, most of
    the text's n-grams are known, and runs of letters are usual in it, if fit() learned which are. Without a model, those with a letter."""
    sent = send(docs.sparkSession, model)

    def run(batches):
        known = received(sent)
        classify = _classifier(known)
        for batch in batches:
            if known is None:
                data, offsets = raw_bytes(batch["text"])
                yield batch.filter(pa.array([has_letter(data[lo:hi]) for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)], pa.bool_()))
                continue
            labels, _, more = classify(batch["text"])
            stays = (np.array(labels, dtype=object) != UNKNOWN) & (more >= ahead)
            data, offsets = raw_bytes(batch["text"])
            for i in np.flatnonzero(stays).tolist():
                stays[i] = known.is_usual(data[offsets[i] : offsets[i + 1]], labels[i])
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
