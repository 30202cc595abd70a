"""Small frames that all operators must take."""

import random

WORDS = "the of and to in is that for with on this was be are as at by from or an it he she they we".split()


def prose(n: int, seed: int, stems=tuple("th er on an re he in ed nd ha es ti or st en at to nt is ou ar ing ve me le de ri co ma ne la si ro li ra ca ni di us lo".split())) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) if r.random() < 0.4 else "".join(r.choice(stems) for _ in range(r.randint(1, 4))) for _ in range(n))


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, FP string, hits int"


def doc(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None, 1.0, "x", 7)


def edge_rows():
    """Nulls in every column, empty, white, one word, very long, repeated rows, null ids, odd characters."""
    long = prose(30_000, 99)
    return [doc(1, None), doc(2, ""), doc(3, " \t\n\x0b\f\r "), doc(4, "word"), doc(5, long), doc(6, long), doc(7, prose(60, 1), None, None),
            doc(7, prose(60, 1), None, None), doc(None, prose(60, 2)), doc(None, prose(60, 2)), doc(None, None, None, None),
            doc(8, "été über ñandú мир 世界 \x00   🙂"), doc(9, "| | | ### $$$ !!!"), doc(10, "x" * 5000)]
