"""Language of each document from its words: scripts narrow the candidates, Viterbi labels spans.

Training adds up, per language, hashed byte n-grams of words and letters per script over all given
rows; the model has languages x buckets numbers whatever the corpus size. A word's score for a
language is the log-likelihood of its n-grams, relative to the best candidate and bounded below,
so that one odd word can't outweigh a span. Candidates of a word are the languages that write its
script (found from Unicode ranges); a script that no learned language writes rules none out. Over
the words of a text, Viterbi with a price for each change of language gives spans. The document's
language is the one with the most letters, its score the share of letters in that language's spans.

Defined cases: null, empty and letterless texts are ``und`` with score 0 and no spans, and so is
everything if no training row has a language. Ties go to the language first by code point. Result
columns take the place of equal-named ones. Texts are used whole, however long; repeated rows get equal results.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import WordIds, byte_grams, per_batch, raw_texts, slabs, spare_name

BUCKETS = 1 << 16
GRAMS = (3, 4)
#: A script belongs to a language that has at least this share of its letters in it.
SCRIPT_SHARE = 0.01
#: Lowest score of a word for a candidate, and for a language that doesn't write its script.
FLOOR, OUTSIDE = -8.0, -16.0
SWITCH = 12.0
UNDETERMINED = "und"
#: A text with a smaller share of its letters in its main language has no language (pipeline stage).
LEAST_SCORE = 0.3
#: Bytes of distinct words whose n-grams are held at once.
PIECE = 200_000

# First code points of script ranges (Unicode blocks), with the script from there on.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1C80, "cyrillic"),
    (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2E80, "han"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"),
    (0xA000, "yi"), (0xA640, "cyrillic"), (0xA720, "latin"), (0xAC00, "hangul"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE30, "han"), (0xFE70, "arabic"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
]
_FROM = [a for a, _ in SCRIPTS]
_NAMES = sorted({s for _, s in SCRIPTS})
_NUMBER = {s: i for i, s in enumerate(_NAMES)}


def script_of(word: bytes) -> tuple[int, int]:
    """(number of the script of a word's first letter or -1, letters of the word)."""
    text = word.decode("utf-8", "replace")
    if text.isalpha():
        return _NUMBER[SCRIPTS[bisect_right(_FROM, ord(text[0])) - 1][1]], len(text)
    letters = [c for c in text if c.isalpha()]
    return (_NUMBER[SCRIPTS[bisect_right(_FROM, ord(letters[0])) - 1][1]], len(letters)) if letters else (-1, 0)


def lowered(text: bytes | None) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().split() if text else []


def pieces(words: list[bytes], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of ``words`` with about ``most`` bytes each (one word at least)."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    lo = 0
    while lo < len(words):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict:
    """The model from all rows of ``docs`` with a language and a text."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), raw_texts(batch.column(1))
            for lo, hi in slabs(texts):
                seen = WordIds()
                used = [(langs[i], seen.of(lowered(texts[i]))) for i in range(lo, hi)]
                words = seen.words
                if not words:
                    continue
                times = {lang: np.bincount(np.concatenate([x for k, x in used if k == lang]), minlength=len(words)) for lang in sorted({x for x, _ in used})}
                for first, last in pieces(words):
                    grams, owner = byte_grams(words[first:last], GRAMS, BUCKETS)
                    kinds = np.array([script_of(w) for w in words[first:last]])
                    known = kinds[:, 0] >= 0
                    for lang, all_n in times.items():
                        n = all_n[first:last]
                        if lang not in sums:
                            sums[lang] = np.zeros(BUCKETS + len(_NAMES))
                        sums[lang][:BUCKETS] += np.bincount(grams, weights=n[owner], minlength=BUCKETS)
                        sums[lang][BUCKETS:] += np.bincount(kinds[known, 0], weights=(n * kinds[:, 1])[known], minlength=len(_NAMES))
        for lang, x in sums.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(x[at].astype(np.int64))], names=["lang", "at", "n"])

    counted = rows.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    packed = counted.groupBy("lang").agg(F.collect_list(F.struct("at", "n")).alias("x")).orderBy("lang")  # at most BUCKETS a language
    langs, tables, scripts = [], [], []
    for r in packed.toLocalIterator():
        x = np.zeros(BUCKETS + len(_NAMES))
        got = np.array([(a, n) for a, n in r["x"]], np.int64).reshape(-1, 2)
        x[got[:, 0]] = got[:, 1]
        langs.append(r["lang"])
        tables.append(np.log((x[:BUCKETS] + 0.5) / (x[:BUCKETS].sum() + 0.5 * BUCKETS)))
        scripts.append(x[BUCKETS:] / max(1.0, x[BUCKETS:].sum()) >= SCRIPT_SHARE)
    allowed = np.array(scripts, bool).reshape(len(langs), len(_NAMES)).T  # by script, then language
    allowed = allowed | ~allowed.any(axis=1, keepdims=True) if len(langs) else allowed
    return {"langs": langs, "table": np.array(tables, np.float32).reshape(len(langs), BUCKETS).T.copy(), "allowed": allowed}


def word_scores(words: list[bytes], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(scores by word and language, letters by word); n-grams of a bounded piece of the words at a time."""
    scores = np.empty((len(words), model["table"].shape[1]), np.float32)
    letters = np.empty(len(words), np.int64)
    for lo, hi in pieces(words):
        scores[lo:hi], letters[lo:hi] = _some_scores(words[lo:hi], model)
    return scores, letters


def _some_scores(words: list[bytes], model: dict) -> tuple[np.ndarray, np.ndarray]:
    grams, owner = byte_grams(words, GRAMS, BUCKETS)
    table = model["table"]
    scores = np.stack([np.bincount(owner, weights=table[grams, k], minlength=len(words)) for k in range(table.shape[1])], axis=1)
    kinds = np.array([script_of(w) for w in words])
    allowed = model["allowed"][np.maximum(kinds[:, 0], 0)]
    best = np.where(allowed, scores, -np.inf).max(axis=1, keepdims=True)
    scores = np.where(allowed, np.maximum(scores - best, FLOOR), OUTSIDE)
    scores[kinds[:, 0] < 0] = 0.0
    return scores.astype(np.float32), kinds[:, 1]


def viterbi(scores: np.ndarray, ids: np.ndarray, lens: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word of texts that stand one after another in ``ids`` and have
    ``lens`` words; all texts go one word further at each step."""
    n_lang = scores.shape[1]
    order = np.argsort(-lens, kind="stable")
    starts = (np.cumsum(lens) - lens)[order]
    lens = lens[order]
    steps = int(lens[0]) if len(lens) else 0
    active = np.searchsorted(-lens, -np.arange(steps), side="left")  # texts with a word at each step
    value = np.zeros((len(lens), n_lang))
    back = np.zeros((len(ids), n_lang), np.uint8 if n_lang < 256 else np.int32)
    own = np.arange(n_lang)
    for t in range(steps):
        k = active[t]
        at = starts[:k] + t
        v = value[:k]
        best = v.argmax(axis=1)
        moved = v[np.arange(k), best] - switch
        take = moved[:, None] > v
        back[at] = np.where(take, best[:, None], own)
        value[:k] = np.where(take, moved[:, None], v) + scores[ids[at]]
    state = value.argmax(axis=1)
    out = np.zeros(len(ids), np.int64)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        out[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType()), T.StructField("lang", T.StringType())]))


def predict(docs: DataFrame, model: dict, text_col: str = "text", pred: str = "lang_pred", score: str = "score", spans: str | None = None) -> DataFrame:
    """``docs`` with the language and score of each text and, if ``spans`` names a column, its spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers
    fields = [(pred, T.StringType()), (score, T.DoubleType())] + ([(spans, SPAN)] if spans else [])

    def make():
        model = shared.value
        langs = model["langs"]

        def some(texts: list) -> tuple[list, list, list]:
            seen = WordIds()
            ids = [seen.of(lowered(t)) for t in texts]
            lens = np.array([len(x) for x in ids])
            words = seen.words
            if not words or not langs:
                return [UNDETERMINED] * len(texts), [0.0] * len(texts), [[]] * len(texts)
            table, letters = word_scores(words, model)
            flat = np.concatenate(ids)
            labels = viterbi(table, flat, lens)
            owner = np.repeat(np.arange(len(texts)), lens)
            mass = np.bincount(owner * len(langs) + labels, weights=letters[flat], minlength=len(texts) * len(langs)).reshape(-1, len(langs))
            total, best = mass.sum(axis=1), mass.argmax(axis=1)
            names = [langs[b] if n else UNDETERMINED for b, n in zip(best, total)]
            found = []
            if spans:
                new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
                runs = np.diff(np.append(new, len(flat)))
                begin = np.cumsum(lens) - lens
                found = [[] for _ in texts]
                for at, n in zip(new.tolist(), runs.tolist()):
                    if total[owner[at]]:
                        found[owner[at]].append({"first": at - int(begin[owner[at]]), "words": n, "lang": langs[labels[at]]})
            return names, (mass.max(axis=1) / np.maximum(total, 1)).tolist(), found

        def work(texts: list) -> list:
            out: list[list] = [[], [], []]
            for lo, hi in slabs(texts):
                for x, got in zip(out, some(texts[lo:hi])):
                    x.extend(got)
            return out[: len(fields)]

        return work

    return per_batch(docs, text_col, fields, make)


def keep_known(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is known: not ``und``, and with a share of letters of at least
    ``least`` in it. Learns from the rows of ``docs`` that name a language."""
    pred, score = spare_name(docs.columns, "lang_pred"), spare_name(docs.columns, "lang_score")
    found = predict(docs, train(docs, lang_col, text_col), text_col, pred, score)
    return found.filter((F.col(pred) != UNDETERMINED) & (F.col(score) >= least)).select(*docs.columns)
