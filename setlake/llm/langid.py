"""Language identification by rank-order profiles.

A profile is a ranked list of the most frequent letter n-grams (one to three letters, words padded
by a space). A text's own profile is compared to each language's by the out-of-place distance: the
sum over its n-grams of the difference in rank, a fixed penalty standing for n-grams that the
language's profile lacks. The nearest language wins.

Profiles are learned for every label, from at most about ``rows_per_language`` of its rows, taken by a hash of the id: a bound that is
a parameter. Whole texts are read in training and prediction. Memory grows with the labels, by a profile each.

Defined cases: a null text or one without a letter (Unicode class L) is ``und`` with score 0; null labels teach
nothing; with no labelled row at all, as in an empty table, every text is ``und``; ties of distance go to the language first in
order, ties of frequency to the smaller code; very long texts are counted whole, slice by slice; repeated rows each teach
and are each told; an empty table gives an empty result; extra columns pass through or are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlake.llm.common import arrow_rows, begin_work

#: Length of a profile, and labelled rows that each language may learn from.
PROFILE, ROWS_PER_LANGUAGE = 400, 20_000
#: Labels whose shares are broadcast; more are joined as any table.
SHARES = 100_000
#: Code points of a text counted at once, which bounds the memory of very long texts.
_SLICE = 1 << 18
#: A word: letters and the marks on them; numerals of any kind are no letters.
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
Profiles = dict[str, list[int]]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed as 21 bits a character, and how often each occurs."""
    words = " ".join(_WORD.findall((text or "").lower()))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    found = []
    for at in range(0, len(points) - 2, _SLICE):
        p = points[at : at + _SLICE + 2]
        two = (p[:-1] << 21) | p[1:]
        three = (two[:-1] << 21) | p[2:]
        one = p[1:-1]
        found.append(np.unique(np.concatenate([one[one != 32], two[:-1], three[(three & 0x1FFFFF << 21) != 32 << 21]]), return_counts=True))
    if len(found) == 1:
        return found[0]
    grams, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return grams, np.bincount(back, weights=np.concatenate([f[1] for f in found])).astype(np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent n-grams; equal counts by code, so that ranks are determined."""
    if len(grams) > 2 * n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))][:n]


def learn(df: DataFrame, teach: Column, profile: int = PROFILE, rows_per_language: int = ROWS_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """A profile for each label among the rows where ``teach`` holds.

    The driver gets ``profile`` n-grams a language, whatever the size of the corpus.
    """
    labelled = df.filter(teach & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)).alias("spread"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    shares = df.sparkSession.createDataFrame([(lang, min(1.0, rows_per_language / n)) for lang, n in sizes.items()], "lang string, share double")
    taught = labelled.join(F.broadcast(shares) if len(sizes) <= SHARES else shares, "lang").filter(F.col("spread") < F.col("share") * (1 << 20))

    def count(batches):
        begin_work(__name__)
        total: dict[str, list[pd.Series]] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total.setdefault(lang, []).append(pd.Series(*ngram_counts(text)[::-1]))
                if len(total[lang]) >= 200:
                    total[lang] = [pd.concat(total[lang]).groupby(level=0).sum()]
        for lang, parts in total.items():
            done = pd.concat(parts).groupby(level=0).sum()
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(done), "gram": done.index.to_numpy(np.int64), "n": done.to_numpy(np.int64)})

    counted = taught.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = totals.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("r") <= profile)
    out: Profiles = {lang: [] for lang in sizes}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["r"])):
        out[r["lang"]].append(r["gram"])
    return {k: v for k, v in sorted(out.items()) if v}


def classifier(profiles: Profiles, profile: int = PROFILE) -> Callable[[str | None], tuple[str, float]]:
    """Text to (language, score from 0 to 1). The score is how near the text comes to the profile: 1 is the profile itself."""
    langs = list(profiles)
    entries = np.concatenate([np.array(profiles[x], np.int64) for x in langs]) if langs else np.zeros(0, np.int64)
    whose = np.repeat(np.arange(len(langs)), [len(profiles[x]) for x in langs])
    ranks = np.concatenate([np.arange(len(profiles[x])) for x in langs]) if langs else entries
    order = np.argsort(entries, kind="stable")
    whose, ranks = whose[order], ranks[order]
    grams, starts, sizes = np.unique(entries[order], return_index=True, return_counts=True)

    def predict(text: str | None) -> tuple[str, float]:
        own = ranked(*ngram_counts(text), profile)
        if not len(own) or not langs:
            return "und", 0.0
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        place = np.flatnonzero(grams[at] == own)
        at = at[place]
        # the entries of all profiles that hold a gram of the text: each is nearer than one that is lacking
        n = sizes[at]
        here = np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        nearer = profile - np.abs(ranks[here] - np.repeat(place, n))
        away = profile * len(own) - np.bincount(whose[here], weights=nearer, minlength=len(langs)).astype(np.int64)
        best = int(away.argmin())
        return langs[best], float(1 - away[best] / (profile * len(own)))

    return predict


def identify(df: DataFrame, profiles: Profiles, profile: int = PROFILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, lang_pred, score. Only the text is looked at."""
    predict = classifier(profiles, profile)

    def rows(ids: list, texts: list) -> dict:
        found = [predict(t) for t in texts]
        return {"doc_id": ids, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return arrow_rows(df.select(id_col, text_col), rows, f"doc_id {dict(df.dtypes)[id_col]}, lang_pred string, score double")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether an id belongs to the fold that nothing is learned from: the CRC-32 of its decimal text is a multiple of ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def keep_identified(df: DataFrame, profiles: Profiles, profile: int = PROFILE, min_score: float = 0.0, text_col: str = "text") -> DataFrame:
    """``df`` without rows that are ``und`` or score under ``min_score``; columns as given."""
    predict = classifier(profiles, profile)

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        begin_work(__name__)
        found = [predict(t) for t in texts]
        return pd.Series([lang != "und" and score >= min_score for lang, score in found], dtype=bool)

    return df.filter(keep(F.col(text_col)))
