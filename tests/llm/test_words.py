"""Word borders and hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from logwright.llm import words as W

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXT = st.text(alphabet="ab Z\t\n\x0b\x0c\ré　 \x1c#", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=12), st.integers(1, 40))
def test_words_and_windows(texts, size):
    old, W.SLICE = W.SLICE, size
    try:
        seen = {}
        for s in W.slices(pa.array(texts, pa.string())):
            h = s.hashes()
            win, ptr = W.windows(h, s.ptr, 3)
            for k in range(len(s)):
                want = WORD.findall(texts[s.first + k] or "")
                got = [s.data[a:b].tobytes().decode() for a, b in
                       zip(s.starts[s.ptr[k]:s.ptr[k + 1]], s.ends[s.ptr[k]:s.ptr[k + 1]])]
                assert got == want
                for w, x in zip(want, h[s.ptr[k]:s.ptr[k + 1]].tolist()):
                    assert seen.setdefault(w, x) == x
                grams = [tuple(want[i:i + 3]) for i in range(len(want) - 2)]
                assert ptr[k + 1] - ptr[k] == len(grams)
                for g, x in zip(grams, win[ptr[k]:ptr[k + 1]].tolist()):
                    assert seen.setdefault(g, x) == x
                ls, le, lp = s.lines()
                base = s.offsets[k]
                assert [s.data[a:b].tobytes() for a, b in zip(ls[lp[k]:lp[k + 1]], le[lp[k]:lp[k + 1]])] \
                    == s.data[base:s.offsets[k + 1]].tobytes().split(b"\n")
        assert len(set(seen.values())) == len(seen)
    finally:
        W.SLICE = old


def test_very_long_words_hash_alike_everywhere():
    long = "x" * (W.LONG_WORD + 5)
    a = list(W.slices(pa.array([f"a {long} b", f"{long}"])))
    hashes = np.concatenate([s.hashes() for s in a])
    assert hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3
