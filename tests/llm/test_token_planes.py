"""Token files in planes."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from teletally.llm import token_planes
from tests.llm.cases import ODD, docs, texts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def expected(rows):
    """Rows of the query by plain Python: nulls first, then ascending ids, then any order of the texts."""
    return sorted((str(i), len(ids), crc32(packed(ids))) for i, ids in ((i, library(t)) for i, t in rows))


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_there_and_back(kind):
    rng = np.random.default_rng(1)
    for size in (0, 1, 7, 8, 9, 1000):
        for most in (2, 50_000, 2**32):
            ids = rng.integers(0, most, size, dtype=np.uint64).astype("<u4")
            planes = token_planes.to_planes(ids, kind)
            assert len(planes) == (4 if kind == "byte" else 32)
            assert token_planes.from_planes([p.tobytes() for p in planes], size).tolist() == ids.tolist()
    # By the definition: bit k of id j is bit j of plane k.
    ids = rng.integers(0, 2**32, 50, dtype=np.uint64).astype("<u4")
    for k, plane in enumerate(token_planes.to_planes(ids, "bit")):
        assert [plane[j // 8] >> (j % 8) & 1 for j in range(50)] == [int(i) >> k & 1 for i in ids]


def test_words_are_encoded_as_the_library_does():
    rng = random.Random(2)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_planes.WordEncoder(file.read())
    signs = [*" \n\t.,!?;:'<|>\u00a0\u2003\u0301\u0338\u0345", "'s", "Ab", "\u00c9", "e", "\u03a3", "x1", "\u4e2d", "\u1100\u1161",
             "<|endoftext|>", "\u037e", "\u0130", "\U0001f642", "\x00", "\x85", "\u1680", "K", "\u212b"]
    made = ["".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(20_000)] + texts(3, 50)
    for low in range(0, len(made), 500):
        some = made[low : low + 500]
        ids, borders = encoder.encode(pa.array(some, pa.string()))
        for k, text in enumerate(some):
            assert ids[borders[k] : borders[k + 1]].tolist() == library(text)[:-1], text


def test_joined_checksums():
    rng = random.Random(3)
    for _ in range(50):
        a, b = rng.randbytes(rng.randint(0, 400)), rng.randbytes(rng.randint(0, 400))
        assert token_planes.joined_crc(crc32(a), crc32(b), len(b)) == crc32(a + b)


@pytest.mark.parametrize(("chunk", "kind"), [(1, "byte"), (7, "bit"), (1000, "byte"), (2**16, "byte")])
def test_files_hold_what_the_library_gives(spark, tmp_path, chunk, kind):
    rows = [*ODD[:7], *ODD[9:], *[(100 + k, t) for k, t in enumerate(texts(4, 25, 20))], (2**62 + 1, "far off"), (-(2**63), "low")]
    path = str(tmp_path / "files")
    token_planes.write_token_files(docs(spark, rows), path, PATH, chunk=chunk, planes=kind)
    sums = sorted(token_planes.checksums(spark, path).collect(), key=lambda r: r.start)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in sums) == expected(rows)
    # Starts follow on each other in ascending order of the ids, those without one first.
    place = 0
    for r in sums:
        assert r.start == place
        place += r.n_tokens
    order = [r.doc_id for r in sums]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    whole = {r.start: (r.doc_id, r.n_tokens, r.ids) for r in token_planes.read_documents(spark, path).collect()}
    assert {s: (i, n, crc32(ids)) for s, (i, n, ids) in whole.items()} == {r.start: (r.doc_id, r.n_tokens, r.ids_crc32) for r in sums}
    every = b"".join(whole[s][2] for s in sorted(whole))
    index = sorted((r["first"], r.n) for r in token_planes.chunk_index(spark, path).collect())
    assert sum(n for _, n in index) == place and max(n for _, n in index) <= chunk
    for low, high in ((0, place), (5, 6), (place // 3, place // 2), (place, place + 5)):
        got = sorted(token_planes.read_range(spark, path, low, high).collect())
        assert b"".join(r.ids for r in got) == every[4 * low : 4 * high]


def test_query(spark):
    assert token_planes.document_checksums(docs(spark, []), PATH).count() == 0
    rows = [*ODD, *[(50, "the same row")] * 40]
    found = token_planes.document_checksums(docs(spark, rows), PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == expected(rows)


def test_other_tokenizers_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="white space"):
        token_planes.write_token_files(docs(spark, ODD), str(tmp_path / "x"), public_tokenizers.path("byte_bpe_50k.json"))
