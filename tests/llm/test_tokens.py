import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spillway.llm import tokens

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB zé\tÉ\n\x0b_1,\U0001f600× ", max_size=30)), max_size=8)


def hashes(texts, **options):
    data, offs = tokens.buffers(pa.array(texts, pa.string()))
    out = []
    for a, b in tokens.chunks(offs, 16):
        h, at, _, _ = tokens.words(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], **options)
        out += [list(h[x:y]) for x, y in zip(at[:-1], at[1:])]
    return out


def same_partition(found, wanted):
    """Hashes are equal exactly where words are equal."""
    flat, words = [x for r in found for x in r], [x for r in wanted for x in r]
    assert [len(r) for r in found] == [len(r) for r in wanted]
    assert len(set(zip(flat, words))) == len(set(flat)) == len(set(words))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_blank_separated_words(texts):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    same_partition(hashes(texts, is_word=tokens.BLANK, fold_latin=False),
                   [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for t in texts])


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_plain_words_fold_latin_letters(texts):
    same_partition(hashes(texts), [re.findall(r"[a-z0-9_\x80-\U0010ffff]+", (t or "").lower()) for t in texts])


def test_prefixes_are_letters_not_bytes():
    data, offs = tokens.buffers(pa.array(["éèàùx éèàùyz abc", "éèàùqqq"]))
    _, _, _, stems = tokens.words(data, offs, prefixes=(4, 2))
    assert stems[0][0] == stems[0][1] == stems[0][3] != stems[0][2]
    assert len(set(stems[1].tolist())) == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=6), st.integers(1, 4), st.booleans())
def test_grams_stay_inside_rows(sizes, n, short):
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 3, k).astype(np.uint64) for k in sizes]
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    g, per = tokens.grams(np.concatenate([*rows, np.zeros(0, np.uint64)]), at, n, short)
    want = [[tuple(r[i:i + n]) for i in range(len(r) - n + 1)] or ([tuple(r)] if short and len(r) else []) for r in rows]
    assert list(np.diff(per)) == [len(w) for w in want]
    flat = [x for w in want for x in w]
    assert len(set(zip(g.tolist(), flat))) == len(set(flat)) == len(set(g.tolist()))


def test_chunks_cover_every_row_once():
    offs = np.array([0, 5, 5, 100, 101, 101])
    assert list(tokens.chunks(offs, 10)) == [(0, 2), (2, 3), (3, 5)]
