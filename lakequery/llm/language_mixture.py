"""Languages of documents, as a mixture fitted by expectation-maximisation.

A language is a distribution of byte trigrams, counted over all labelled training texts. A document is taken for a mixture of
them; EM estimates the proportions, and of the nested sets of its likeliest languages the one with the best likelihood
less a penalty for each language is chosen and refitted. The prediction is the largest proportion, which is the score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.llm.common import bounded, ids_of, slices, small_batches, texts_of

#: Trigrams are hashed to so many bits; the model is languages x 2^16 numbers.
BITS = 16
#: Share that the likeliest language of a document has at least, for identified() to keep it.
LEAST_SHARE = 0.5
LETTER = regex.compile(r"\p{L}")
#: A-Z become a-z, other ASCII but letters a space; other bytes stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def trigrams(text: bytes) -> np.ndarray:
    b = np.frombuffer(b" " + text.translate(TABLE) + b" ", dtype=np.uint8).astype(np.uint32)
    return ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


@bounded
def _counts(batches):
    held: dict[str, np.ndarray] = {}

    def flush():
        for lang, c in held.items():
            f = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), pa.array(f.astype(np.int32)), pa.array(c[f])], names=["lang", "f", "n"])
        held.clear()

    for b in slices(batches, limit=1_000_000):
        by: dict[str, list[bytes]] = {}
        for lang, t in zip(ids_of(b, "lang"), texts_of(b), strict=True):
            by.setdefault(lang, []).append(t)
        for lang, ts in by.items():
            c = np.bincount(np.concatenate([trigrams(t) for t in ts]), minlength=1 << BITS)
            held[lang] = held[lang] + c if lang in held else c
        if len(held) > 100:
            yield from flush()
    yield from flush()


class Mixture:
    """Language distributions, and the fit of a document to them."""

    def __init__(self, langs: list[str], counts: np.ndarray, smoothing: float = 0.5, penalty: float = 2.0, rounds: int = 12) -> None:
        """counts: trigram buckets x languages."""
        self.langs, self.penalty, self.rounds = langs, penalty, rounds
        p = (counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts))
        self.p = (p / p.mean(axis=1, keepdims=True)).astype(np.float32)  # per bucket, over their mean: proportions stay the same

    def _em(self, x: np.ndarray, n: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, float]:
        """Of trigrams with likelihoods x that occur n times each; each round gives a language the share of the trigrams it answers for."""
        for _ in range(self.rounds if len(theta) > 1 else 0):
            theta = theta * (x.T @ (n / np.maximum(x @ theta, 1e-30)))
            theta /= theta.sum()
        return theta, float(np.dot(n, np.log(np.maximum(x @ theta, 1e-30)).astype(np.float64)))

    def fit(self, text: bytes) -> list[tuple[str, float]]:
        """Languages of the chosen set with their proportions, largest first (ties by name)."""
        found, times = np.unique(trigrams(text), return_counts=True)  # at most 2^16, however long the text
        x, times, total = self.p[found], times.astype(np.float32), int(times.sum())
        n = len(self.langs)
        theta, _ = self._em(x, times, np.full(n, 1.0 / n, dtype=np.float32))
        order = sorted(range(n), key=lambda i: (-theta[i], self.langs[i]))
        best = None
        for size in range(1, n + 1):
            if size > 1 and theta[order[size - 1]] < 0.01:
                break
            chosen = order[:size]
            t, ll = self._em(x[:, chosen], times, theta[chosen] / theta[chosen].sum())
            value = ll - self.penalty * size * np.log(total + 1.0)
            if best is None or value > best[0]:
                best = (value, chosen, t)
        return sorted(((self.langs[i], float(p)) for i, p in zip(best[1], best[2], strict=True)), key=lambda x: (-x[1], x[0]))


def train(docs: DataFrame, penalty: float = 2.0) -> Mixture | None:
    """From text and non-null lang of all rows of docs; None if there are none. The driver gets languages x 2^16 counts at most."""
    small_batches(docs.sparkSession)
    labelled = docs.where("lang is not null and text is not null").select("lang", "text")
    table = labelled.mapInArrow(_counts, "lang string, f int, n long").groupBy("lang", "f").agg(F.sum("n").alias("n")).toArrow()
    if not table.num_rows:
        return None
    langs = sorted(set(table["lang"].unique().to_pylist()))
    place = {x: i for i, x in enumerate(langs)}
    d = table["lang"].combine_chunks().dictionary_encode()
    column = np.array([place[x] for x in d.dictionary.to_pylist()])[d.indices.to_numpy()]
    counts = np.zeros((1 << BITS, len(langs)))
    counts[table["f"].to_numpy(), column] = table["n"].to_numpy()
    return Mixture(langs, counts, penalty=penalty)


def _predict(held, columns: list[str], drop_rejected: bool):
    def run(batches):
        for b in slices(batches, limit=1_000_000):
            model: Mixture | None = held.value
            preds, scores, sets, told = [], [], [], []
            for t in texts_of(b):
                letters = LETTER.search(t.decode("utf-8", "replace")) is not None
                if model is None or not letters:
                    told.append(letters)
                    preds.append("und")
                    scores.append(0.0)
                    sets.append([])
                    continue
                fit = model.fit(t)
                told.append(fit[0][1] >= LEAST_SHARE - 1e-6)
                preds.append(fit[0][0])
                scores.append(min(1.0, max(0.0, fit[0][1])))
                sets.append([{"lang": k, "share": v} for k, v in fit])
            if drop_rejected:
                yield b.filter(pa.array(told, pa.bool_()))
            else:
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in columns), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)], names=[*columns, "lang_pred", "score", "languages"])

    return bounded(run)


def held_out(modulus: int = 4) -> Column:
    """crc32 of doc_id as text, modulo; remainder 2 is held out. A null doc_id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == 2, F.lit(False))


def identify(docs: DataFrame, penalty: float = 2.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (the chosen set with shares) of every document.

    Trained on the rows that are not held out and have a lang and a text; lang, source and doc_id are no inputs of a
    prediction. A null text, one without a letter, or no training rows at all give `und` and 0. Repeated rows are
    predicted alike. Other columns are ignored."""
    model = train(docs.where(~held_out()).select("lang", "text"), penalty)
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predict(held, ["doc_id", "held_out"], False), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


def identified(docs: DataFrame, penalty: float = 2.0) -> DataFrame:
    """The rows of docs, all columns, with a letter and a language that holds at least LEAST_SHARE of the fitted mixture.

    A null text has no letter. Repeated rows and rows that share a doc_id are judged each, alike for like texts; a null doc_id
    counts as not held out. An empty table stays empty. Where no training row has a lang, nothing can be told of languages and all rows with a letter are kept."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs.where(~held_out()).select("lang", "text"), penalty))
    return docs.mapInArrow(_predict(held, [], True), docs.schema)
