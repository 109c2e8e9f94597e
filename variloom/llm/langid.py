"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector, made from its code point and a seed. The vector of three
letters is the product of the first rotated twice, the second rotated once and the third; a
document's vector is the sum over its letter triples, with word borders as a letter. A language's
prototype is the sum over its labelled documents. A document gets the language of highest cosine.

Learning covers every labelled document given. Only one vector per language and task reaches the
driver, for at most ``MAX_LANGUAGES`` languages.

Cases: a null text or one without letter gets ``und`` and score 0; documents with a null label
teach nothing; without any labelled text everything is ``und``; equal cosines go to the first
language in code point order; repeated documents each get a row; clashing columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variloom.llm.tables import pick
from variloom.llm.textbytes import mix, text_runs

DIMENSIONS = 1024
MAX_LANGUAGES = 2048
#: Bytes of text turned into vectors at once, and letter triples multiplied at once.
RUN, STEP = 256 << 10, 4096

_U = np.uint64
_CODES = 1 << 21


@lru_cache(1)
def _letter_table() -> np.ndarray:
    """Code point to its lower-case letter, 0 for everything that is not a letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


@lru_cache(1 << 16)
def _letter(code: int) -> np.ndarray:
    words = mix(np.arange(DIMENSIONS // 64, dtype=_U) + _U((code + 1) * DIMENSIONS) + _U(0x5851F42D4C957F2D))
    return np.unpackbits(words.view(np.uint8)).astype(np.int8) * 2 - 1


def _triples(text: str) -> np.ndarray:
    """The letter triples of a text as numbers, in order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letter_table()[codes].astype(_U)
    inside = letters > 0
    if not inside.any():
        return np.zeros(0, _U)
    # a run of other characters is one border, and there is one at either end
    keep = inside | np.concatenate((inside[1:], [False])) & ~inside
    line = np.concatenate(([_U(0)] if inside[0] else [], letters[keep], [_U(0)])).astype(_U)
    return (line[:-2] * _U(_CODES) + line[1:-1]) * _U(_CODES) + line[2:]


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter triples of some texts and how often each occurs."""
    return np.unique(np.concatenate([_triples(t) for t in texts]), return_counts=True)


def _vectors(triples: np.ndarray) -> np.ndarray:
    """One row per triple: rotated letter vectors multiplied."""
    parts = [(triples >> _U(42)) & _U(_CODES - 1), (triples >> _U(21)) & _U(_CODES - 1), triples & _U(_CODES - 1)]
    out = np.ones((len(triples), DIMENSIONS), np.int8)
    for turn, codes in zip((2, 1, 0), parts):
        distinct, place = np.unique(codes, return_inverse=True)
        out *= np.stack([np.roll(_letter(int(c)), turn) for c in distinct])[place]
    return out


def bundle(texts: list[str | None]) -> np.ndarray:
    """Document vectors: the sum of the vectors of all letter triples."""
    grams = [_grams([t or ""]) for t in texts]
    sums = np.zeros((len(texts), DIMENSIONS), np.float32)
    triples = np.unique(np.concatenate([g for g, _ in grams])) if grams else np.zeros(0, _U)
    for low in range(0, len(triples), STEP):
        part = triples[low:low + STEP]
        counts = np.zeros((len(texts), len(part)), np.float32)
        for row, (g, n) in enumerate(grams):
            a, b = np.searchsorted(g, (part[0], part[-1] + _U(1)))
            counts[row, np.searchsorted(part, g[a:b])] = n[a:b]
        sums += counts @ _vectors(part).astype(np.float32)
    return sums


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names in code point order and their prototypes as rows of length 1."""
    rows = pick(labelled, text=text, lang=lang).where("lang is not null and text is not null").withColumn("lang", F.col("lang").cast("string"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, dict[int, int]] = {}
        vectors: dict[str, np.ndarray] = {}

        def fold(name: str) -> None:
            own = counted.pop(name)
            codes = np.fromiter(own, _U, len(own))
            order = np.argsort(codes)
            codes, n = codes[order], np.fromiter(own.values(), np.float64, len(own))[order]
            for low in range(0, len(codes), STEP):
                vectors[name] = vectors.get(name, 0) + n[low:low + STEP] @ _vectors(codes[low:low + STEP]).astype(np.float64)

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for run in text_runs(batch.column(0)):
                by: dict[str, list[str]] = {}
                for i in range(len(run)):
                    by.setdefault(langs[run.first + i], []).append(run.text(i).decode("utf-8", "replace"))
                for name, texts in by.items():
                    codes, n = _grams(texts)
                    own = counted.setdefault(name, {})
                    for c, k in zip(codes.tolist(), n.tolist()):
                        own[c] = own.get(c, 0) + k
                    if len(own) > 1 << 16:
                        fold(name)
        for name in list(counted):
            fold(name)
        names = sorted(vectors)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([vectors[n].tolist() for n in names], pa.list_(pa.float64()))], ["lang", "v"])

    parts = rows.mapInArrow(sums, "lang string, v array<double>")
    summed = (parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")))
    found = summed.select("lang", F.expr("transform(v, p -> p.x)").alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct labels are not languages")
    found.sort(key=lambda r: r.lang.encode())
    matrix = np.array([r.v for r in found], np.float64).reshape(len(found), DIMENSIONS)
    return [r.lang for r in found], matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with that language's prototype, at least 0."""
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    model = docs.sparkSession.sparkContext.broadcast((names, prototypes.T.astype(np.float32)))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, matrix = model.value
        for batch in batches:
            best, score = [], []
            for run in text_runs(batch.column(batch.schema.get_field_index(text)), RUN):
                sums = bundle([run.text(i).decode("utf-8", "replace") for i in range(len(run))])
                norms = np.linalg.norm(sums, axis=1)
                if labels:
                    cosines = (sums @ matrix) / np.maximum(norms, 1e-30)[:, None]
                    at = cosines.argmax(axis=1)
                    known = norms > 0
                    best += [labels[a] if k else "und" for a, k in zip(at, known)]
                    score += [min(1.0, max(0.0, float(c))) if k else 0.0 for c, k in zip(cosines[np.arange(len(at)), at], known)]
                else:
                    best += ["und"] * len(run)
                    score += [0.0] * len(run)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 2)], pa.array(best, pa.string()), pa.array(score, pa.float64())], schema=batch.schema)

    return rows.mapInArrow(mark, rows.schema)
