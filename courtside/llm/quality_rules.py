"""Quality rules: simple counts of a text, and how well a public tokeniser's vocabulary fits it.

Base counts reject texts with few words or with many words in repeated 5-word windows. Tokeniser
fertility rejects further: characters per token (few: text that the vocabulary doesn't know), the
share of tokens that hold only a part of a character (byte fallback), and the entropy of the
text's tokens relative to the largest that so many tokens (``ROOM`` at most, as the entropy of
running text stops growing there) can have (low: the same few tokens again and again). Each script has its own bands, a parameter; a text belongs to the script
of most of its letters.

Distinct words are encoded once for many texts (with a space in front, as in running text) and
each text's tokens are gathered from them, so the tokeniser works once per word form.

Defined cases: null, empty and white texts have no words, fail the base rules and are not kept;
their fertility figures are null. Texts are read whole. Repeated rows get equal results; no ties.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from courtside.llm.common import WHITE, WordIds, per_batch, slabs
from courtside.llm.langid import _NAMES, script_of

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Cuts a text before the merges of the vocabulary (fixed value: it belongs to the public file).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
#: Per script: least and most characters a token, most byte-fallback share, least relative entropy.
#: Bands are wide: they hold what running text of a script shows, with room.
BANDS = {"latin": (1.5, 8.0, 0.15, 0.62), "other": (0.3, 12.0, 0.95, 0.4)}
ROOM = 1024
#: Word forms kept encoded in a task before it starts anew.
FORMS = 400_000


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that stand in a window of so many words found twice or more, the first included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code, size = ids[:n], int(ids.max()) + 1
    for k in range(1, window):
        if size > (1 << 62) // (int(ids.max()) + 1):  # number the windows so far anew, exactly
            code = np.unique(code, return_inverse=True)[1]
            size = int(code.max()) + 1
        code = code * (int(ids.max()) + 1) + ids[k : k + n]
        size *= int(ids.max()) + 1
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    if not len(at):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


class Forms:
    """Word forms with their tokens, one after another."""

    def __init__(self, encoding, partial: np.ndarray) -> None:
        self.encoding, self.partial = encoding, partial
        self.clear()

    def clear(self) -> None:
        self.seen, self.tokens, self.lens, self.done = WordIds(), np.zeros(0, np.int32), np.zeros(0, np.int64), 0
        self.kinds = np.zeros((0, 2), np.int64)

    def encode(self) -> None:
        words = self.seen.words[self.done :]
        if words:
            new = [self.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
            self.lens = np.concatenate([self.lens, np.fromiter(map(len, new), np.int64, len(new))])
            self.tokens = np.concatenate([self.tokens, np.fromiter((t for x in new for t in x), np.int32, int(self.lens[self.done :].sum()))])
            self.kinds = np.concatenate([self.kinds, np.array([script_of(w) for w in words]).reshape(-1, 2)])
            self.done += len(words)

    def of_texts(self, flat: np.ndarray, owner: np.ndarray, n: int) -> tuple:
        """By text: tokens, tokens with part of a character, entropy in bits, script number (-1: no letter)."""
        lens = self.lens[flat]
        total = int(lens.sum())
        begin = np.cumsum(self.lens) - self.lens
        at = np.repeat(begin[flat] - (np.cumsum(lens) - lens), lens) + np.arange(total)
        tokens = self.tokens[at]
        own = np.repeat(owner, lens)
        counts = np.bincount(own, minlength=n)
        broken = np.bincount(own, weights=self.partial[tokens], minlength=n)
        pairs = np.sort(own * (len(self.partial) + 1) + tokens)
        new = np.flatnonzero(np.diff(pairs, prepend=-1))
        c = np.diff(np.append(new, total))
        parts = np.bincount(pairs[new] // (len(self.partial) + 1), weights=c * np.log2(c), minlength=n)
        entropy = np.log2(np.maximum(counts, 1)) - parts / np.maximum(counts, 1)
        kinds = self.kinds[flat]
        has = kinds[:, 0] >= 0
        mass = np.bincount(owner[has] * len(_NAMES) + kinds[has, 0], weights=kinds[has, 1], minlength=n * len(_NAMES)).reshape(n, -1)
        return counts, broken, entropy, np.where(mass.sum(axis=1) > 0, mass.argmax(axis=1), -1)


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The rank file (about 1 MB); it goes to the executors as a broadcast."""
    with open(path, "rb") as f:
        return f.read()


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FIELDS = [*((c, T.LongType()) for c in COUNTS), ("base_failed", T.BooleanType()), ("kept", T.BooleanType()),
          ("script", T.StringType()), ("chars_per_token", T.DoubleType()), ("byte_share", T.DoubleType()), ("token_entropy", T.DoubleType())]


def judge(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, bands: dict | None = None, prefix: str = "") -> DataFrame:
    """``docs`` with the columns of ``FIELDS`` (names after ``prefix``) for each text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    bands = {**BANDS, **(bands or {})}

    def make():
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        part = np.zeros(max(ranks.values()) + 1)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                part[rank] = 1
        forms = Forms(encoding, part)
        white = WHITE.encode()

        def some(texts: list) -> list[list]:
            if len(forms.seen.ids) > FORMS:
                forms.clear()
            counts, ids = [], []
            for t in texts:
                words = t.split() if t else []
                x = forms.seen.of(words)
                ids.append(x)
                if not words:
                    counts.append((0, 0, len(t) - len(t.translate(None, SYMBOLS)) if t else 0, 0, 0))
                    continue
                lines = [ln for ln in t.split(b"\n") if ln.translate(None, white)]
                local = np.unique(x, return_inverse=True)[1]
                counts.append((len(words), len(t.translate(None, white).decode("utf-8", "replace")), len(t) - len(t.translate(None, SYMBOLS)),
                               len(lines) - len(set(lines)), repeated_words(local)))
            forms.encode()
            lens = np.array([len(x) for x in ids])
            flat = np.concatenate(ids)
            tokens, broken, entropy, script = forms.of_texts(flat, np.repeat(np.arange(len(texts)), lens), len(texts))
            n = np.array(counts, np.int64)
            failed = (n[:, 0] < MIN_WORDS) | (100 * n[:, 4] > MAX_REPEAT_PERCENT * n[:, 0])
            some = np.maximum(tokens, 1)
            per, share, rel = n[:, 1] / some, broken / some, entropy / np.log2(np.clip(tokens, 2, ROOM))
            band = np.array([bands.get(_NAMES[s] if s >= 0 else "other", bands["other"]) for s in script])
            fits = (tokens > 0) & (per >= band[:, 0]) & (per <= band[:, 1]) & (share <= band[:, 2]) & (rel >= band[:, 3])
            none = tokens == 0
            return [*n.T, failed, ~failed & fits, [_NAMES[s] if s >= 0 else None for s in script],
                    *(pa.array(x, mask=none) for x in (per, share, entropy))]

        def work(texts: list) -> list:
            out = [some(texts[lo:hi]) for lo, hi in slabs(texts)]
            return [pa.concat_arrays([pa.array(x[i]) if not isinstance(x[i], list) else pa.array(x[i], pa.string()) for x in out]) for i in range(len(FIELDS))]

        return work

    return per_batch(docs, text_col, [(prefix + n, t) for n, t in FIELDS], make)


def keep_good(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, bands: dict | None = None) -> DataFrame:
    """The documents that pass the base rules and fit their script's bands."""
    prefix = "q_"
    while any((prefix + n).lower() in {c.lower() for c in docs.columns} for n, _ in FIELDS):
        prefix = "_" + prefix
    found = judge(docs, text_col, vocabulary, bands, prefix)
    return found.filter(found[prefix + "kept"]).select(*docs.columns)
