"""Language identification by hyperdimensional profiles (operator 3).

Every letter has a random vector of +1 and -1 (from its code point). A trigram's vector binds its
letters' vectors, each rotated by its place, by multiplication; word boundaries count as one more
letter. A text's vector bundles (adds) its trigrams' vectors. A language's prototype bundles the unit
vectors of all its documents that are not held out, and a text gets the language whose prototype has the greatest cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import held_out, holds_caches, keep_only, map_texts

DIMENSIONS = 1024
UNKNOWN = "und"

_LETTERS: dict[tuple[int, int], np.ndarray] = {}
MOST_LETTERS = 20_000_000  # bytes of letter vectors kept by a worker

holds_caches("letters", _LETTERS.clear)


def letter(code: int, dimensions: int) -> np.ndarray:
    """The random vector of a code point (made anew from its number whenever it is not kept)."""
    if (code, dimensions) not in _LETTERS:
        if (len(_LETTERS) + 1) * dimensions > MOST_LETTERS:
            _LETTERS.clear()
        _LETTERS[code, dimensions] = np.random.default_rng(code + 1).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1
    return _LETTERS[code, dimensions]


def bundles(texts: list, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' vectors (float32) and whether each has a letter."""
    low = [f" {(t or '').lower()} " for t in texts]
    sizes = np.array([len(t) for t in low], dtype=np.int64)
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    present = np.flatnonzero(np.bincount(code))
    symbol = np.zeros(int(present[-1]) + 1, dtype=np.int32)
    codes = [0]  # symbol 0: anything but a letter
    for c in present.tolist():
        if chr(c).isalpha():
            symbol[c] = len(codes)
            codes.append(c)
    s = symbol[code]
    keep = np.r_[True, (s[1:] != 0) | (s[:-1] != 0) | (doc[1:] != doc[:-1])]
    s, doc = s[keep], doc[keep]
    has = np.bincount(doc, weights=s > 0, minlength=len(texts)) > 0
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    if len(s) < 3:
        return out, has
    k = len(codes)
    s = s if k**3 < 2**31 else s.astype(np.int64)
    gram = (s[:-2] * k + s[1:-1]) * k + s[2:]
    inside = (doc[:-2] == doc[2:]) & (s[1:-1] > 0)  # a boundary in the middle would join two words
    gram, doc = gram[inside], doc[:-2][inside]
    if not len(gram):
        return out, has
    if k**3 <= 4_000_000:
        found = np.flatnonzero(np.bincount(gram, minlength=k**3))
        index = np.zeros(k**3, dtype=np.int64)
        index[found] = np.arange(len(found))
        at = index[gram]
    else:
        found, at = np.unique(gram, return_inverse=True)
    alphabet = np.stack([letter(c, dimensions) for c in codes]).astype(np.float32)
    first, second = np.roll(alphabet, 2, axis=1), np.roll(alphabet, 1, axis=1)
    step = max(1, 2_000_000 // dimensions)
    rows = max(1, 1_000_000 // min(step, len(found)))
    starts = np.searchsorted(doc, np.arange(0, len(texts) + rows, rows))
    for lo in range(0, len(found), step):
        g = found[lo : lo + step]
        vectors = first[g // (k * k)] * second[g // k % k] * alphabet[g % k]
        for r, (a, z) in enumerate(zip(starts[:-1], starts[1:])):
            base, n = r * rows, min(rows, len(texts) - r * rows)
            if n <= 0 or a == z:
                continue
            cell = at[a:z] - lo
            ok = (cell >= 0) & (cell < len(g)) if len(found) > step else slice(None)
            counts = np.bincount((doc[a:z][ok].astype(np.int64) - base) * len(g) + cell[ok], minlength=n * len(g)).reshape(n, len(g))
            out[base : base + n] += counts.astype(np.float32) @ vectors
    return out, has


@dataclass(frozen=True)
class Profiles:
    """Languages and their unit prototypes."""

    languages: list[str]
    prototypes: np.ndarray

    def predict(self, texts: list) -> dict[str, list]:
        v, has = bundles(texts, self.prototypes.shape[1])
        if not self.languages:
            return {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
        norm = np.linalg.norm(v, axis=1)
        cosine = (v @ self.prototypes.T) / np.maximum(norm, 1e-9)[:, None]
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        return {
            "lang_pred": [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)],
            "score": [float(x) if h else 0.0 for x, h in zip(score, has)],
        }


def _known(docs: DataFrame, sample: int | None, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``(__id, __text, __lang)`` of the documents that are not held out: all, or about ``sample`` per language by the hash of their id."""
    known = docs.where(F.col(f"`{lang_col}`").isNotNull() & ~held_out(id_col)).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"), F.col(f"`{lang_col}`").alias("__lang"))
    if sample is None:
        return known
    counts = known.groupBy("__lang").agg(F.count(F.lit(1)).alias("__n"))
    share = counts.select(F.col("__lang").alias("__of"), F.least(F.lit(1.0), F.lit(float(sample)) / F.col("__n")).alias("__share"))
    # one short row per language; the prototypes, far larger, go to every task as well
    return known.join(F.broadcast(share), F.col("__lang") == F.col("__of")).where(F.pmod(F.xxhash64(F.col("__id").cast("string")), F.lit(1 << 20)) < F.col("__share") * (1 << 20)).select("__id", "__text", "__lang")


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes from documents with a language that are not held out.

    All of them are bundled (with ``sample``: about so many of each language, those of the smallest hash of their id;
    a language with fewer gives all). Partial bundles are added per language across tasks; only the
    prototypes reach the driver.
    """
    known = _known(docs, sample, id_col, text_col, lang_col)

    def run(batches):
        import pandas as pd

        keep_only(None)
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lo in range(0, len(b), 200):
                part = b.iloc[lo : lo + 200]
                v, has = bundles([t if isinstance(t, str) else None for t in part["__text"]], dimensions)
                v = v / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
                for name, rows in part["__lang"].reset_index(drop=True).groupby(part["__lang"].reset_index(drop=True)).groups.items():
                    sums[name] = sums.get(name, 0) + v[np.asarray(rows)].sum(axis=0, dtype=np.float64)
        for name, x in sums.items():
            yield pd.DataFrame({"lang": name, "i": np.arange(dimensions), "x": x})

    partial = known.select("__lang", "__text").mapInPandas(run, "lang string, i int, x double")
    rows = partial.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    got = sorted((r["lang"], [x["x"] for x in r["v"]]) for r in rows.collect())
    p = np.array([v for _, v in got], dtype=np.float64).reshape(len(got), dimensions)
    p = p / np.maximum(np.linalg.norm(p, axis=1), 1e-9)[:, None]
    return Profiles([name for name, _ in got], np.round(p, 6).astype(np.float32))


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, lang_pred, score)`` of every whole text; the text alone decides.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter (or nothing was
    learned); ties go to the first language by name. The score is the cosine, cut to 0 to 1. Repeated rows
    give repeated rows, an empty table an empty one. A text of any length is bundled whole.
    """
    return map_texts(docs, profiles.predict, "lang_pred string, score double", text_col, (id_col, *keep), most=1_000_000, caches="letters")


def length_class(text: Column) -> Column:
    """Texts of 2^n to 2^(n+1) - 1 characters are of class n (null and empty: 0)."""
    return F.floor(F.log2(F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)).cast("double"))).cast("int")


def floors(docs: DataFrame, profiles: Profiles, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[int, float]:
    """The least cosine that a text of each length class should have with some prototype, from the documents that they were learned from.

    A text is foreign to all languages when its cosine is both under half the class's median and under the outer fence
    (the first quartile less three quartile distances). Cosines of short texts vary so much that
    their fence lies below zero: nothing is said about them. Cosines are counted to four places, so a class is at most
    10,001 counts however many documents it has. At most 32 classes reach the driver.
    """
    known = _known(docs, sample, id_col, text_col, lang_col).withColumn("__class", length_class(F.col("__text")))
    found = identify(known, profiles, "__id", "__text", keep=("__class",)).where(F.col("lang_pred") != UNKNOWN)
    counts = found.groupBy("__class", F.round("score", 4).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    quartiles = counts.groupBy("__class").agg(F.percentile("score", [0.25, 0.5, 0.75], F.col("n")).alias("q"))
    return {r["__class"]: min(r["q"][1] / 2, r["q"][0] - 3 * (r["q"][2] - r["q"][0])) for r in quartiles.collect()}


def floor_of(text: Column, found: dict[int, float]) -> Column:
    """The floor of a text's length class, or of the next shorter one that has a floor (cosines rise with length); else 0."""
    out = F.lit(0.0)
    for k, v in sorted(found.items()):
        out = F.when(length_class(text) >= k, F.lit(float(v))).otherwise(out)
    return out
