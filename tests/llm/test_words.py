import random
import re

import numpy as np
import pyarrow as pa

from kawaraban.llm import repeats
from kawaraban.llm.words import MARKS, Words, covered, mix, pieces

ALPHABET = "ab Z\t\n.é日9_"


def texts(n=300):
    rnd = random.Random(3)
    return [None, "", " "] + ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_words_and_windows_equal_the_regular_expressions():
    given = texts()
    for between, pattern, lower in ((None, rb"[^\x20\x09-\x0D]+", False), (MARKS, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        kinds = {} if between is None else {"between": between}
        found = Words(pa.array(given, pa.string()), lower=lower, **kinds)
        want = [re.findall(pattern, (t or "").encode().lower() if lower else (t or "").encode()) for t in given]
        data = found.data.tobytes()
        got = [data[a:b] for a, b in zip(found.starts, found.ends)]
        assert got == [w for ws in want for w in ws]
        assert found.counts.tolist() == [len(w) for w in want]
        hashes, at, row = found.windows(3)
        flat = [(i, tuple(ws[j : j + 3])) for i, ws in enumerate(want) for j in range(len(ws) - 2)]
        assert row.tolist() == [i for i, _ in flat]
        by_hash = {}
        for h, (_, w) in zip(hashes.tolist(), flat):
            assert by_hash.setdefault(h, w) == w
        assert len(by_hash) == len({w for _, w in flat})


def test_slices_of_a_column_give_the_same_hashes():
    given = pa.array(texts(50), pa.string())
    whole = Words(given)
    part = Words(given.slice(20, 11))
    assert part.hashes.tolist() == whole.hashes[whole.bounds[20] : whole.bounds[31]].tolist()


def test_long_spans_hash_as_short_ones():
    word = "x" * (3 << 20)
    both = Words(pa.array([f"a {word} b", f"{word} c"]))
    assert both.hashes[1] == both.hashes[3]


def test_covered_and_pieces():
    assert covered(6, np.array([1, 2]), 2).tolist() == [False, True, True, True, False, False]
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 30, "c"]})
    assert [p.num_rows for p in pieces(iter([batch]), size=12)] == [2, 1, 1]
    assert len(set(mix(np.arange(1000, dtype=np.uint64)).tolist())) == 1000


def test_ranges_of_keys_cover_all_values():
    keys = np.array([0, 2**63, 2**64 - 1], np.uint64)
    assert repeats._ranges(keys, 7).tolist() == [0, 3, 6]
