"""Byte-pair encoding against the tokenizers library."""

import json
import random
from hashlib import sha256
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from teletally.llm import bpe
from tests.llm.cases import ODD, docs, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "the", " ", "  ", "\n", "é", "1", "23", "'s", "!", "$", "日", "\U0001f642", "ing", "ation", "\xa0", "<|endoftext|>"]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary.read(PATH))


def test_every_token_encodes_to_itself(encoder):
    assert all(encoder._whole(i) for i in bpe.Vocabulary.read(PATH).tokens)


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_library(encoder, seed):
    rng = random.Random(seed)
    for _ in range(2500):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 50)))
        ids = library(text)
        assert encoder.encode(text) == ids, text
        assert encoder.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_blanks_beside_other_white_space(encoder):
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choices([" ", "\xa0", "\xa0 ", " \xa0", "\n", "\t", "\u3000", "a", "b1"], k=rng.randint(0, 24)))
        assert encoder.encode(text) == library(text), repr(text)


def test_long_and_repetitive_texts(encoder):
    for text in ("a" + " \xa0" * 9 + " b", "a" * 5000, "ab" * 3000, " " * 3000, "\n \n" * 500, *texts(1, 50)):
        assert encoder.encode(text) == library(text)


def test_specials_as_plain_text(encoder):
    assert 50256 not in encoder.encode("x<|endoftext|>y", specials=False)
    assert encoder.decode(encoder.encode("x<|endoftext|>y", specials=False)) == "x<|endoftext|>y"


def test_ids_that_are_no_text(encoder):
    for ids in ([220, 160], [50256, 1], [127], [], list(range(256))):
        assert encoder.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_query_on_odd_rows(spark):
    rows = [*ODD, *[(100 + k, t) for k, t in enumerate(texts(2, 30))]]
    wanted = sorted(
        (
            str(i),
            len(ids := library(text or "")),
            sha256(",".join(map(str, ids)).encode()).hexdigest(),
            sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
        )
        for i, text in rows
    )
    found = bpe.digests(docs(spark, rows), PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == wanted
    assert bpe.digests(docs(spark, []), PATH).count() == 0


def test_encode_and_decode_tables(spark):
    encoded = bpe.encode(docs(spark, ODD), PATH)
    found = encoded.collect()
    assert sorted((str(r.doc_id), r.ids) for r in found) == sorted((str(i), library(t or "")) for i, t in ODD)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in found)
    back = bpe.decode(encoded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in ODD)
    assert bpe.encode(docs(spark, []), PATH).count() == 0


def small_tokenizer(tmp_path, words, **changes):
    """A byte-level vocabulary file of all bytes and the merges that lead to some words, and the library's tokenizer of it."""
    letters = {b: c for c, b in bpe.byte_letters().items()}
    vocabulary, merges = {letters[b]: b for b in range(256)}, []
    for word in words:
        spelled = "".join(letters[b] for b in word.encode())
        for k in range(2, len(spelled) + 1):
            if spelled[:k] not in vocabulary:
                vocabulary[spelled[:k]] = len(vocabulary)
                merges.append([spelled[: k - 1], spelled[k - 1]])
    read = json.loads(Path(PATH).read_text(encoding="utf-8"))
    read["model"] |= {"vocab": vocabulary, "merges": merges}
    read["added_tokens"] = []
    read["model"] |= changes.pop("model", {})
    path = tmp_path / "small.json"
    path.write_text(json.dumps(read | changes))
    return str(path)


def test_tokens_that_join_blanks_to_other_white_space(tmp_path):
    path = small_tokenizer(tmp_path, ["\n \n", " \n \n", "\t ", "\u00a0 ", " a", "ab", "\n\n  "])
    small, its = bpe.Encoder(bpe.Vocabulary.read(path)), Tokenizer.from_file(path)
    assert {"\n", "\t", "\u00a0"} <= set(small._joins_blanks)
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(["a", "b", " ", "\n", "\t", "\u00a0", "1", " a"], k=rng.randint(0, 14)))
        assert small.encode(text) == its.encode(text, add_special_tokens=False).ids, repr(text)


def test_vocabularies_of_other_kinds_are_refused(tmp_path):
    with pytest.raises(ValueError, match="cut by Sequence"):
        bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    token = {"id": 300, "content": "<x>", "single_word": False, "lstrip": True, "rstrip": False, "normalized": False, "special": True}
    for changes in (
        {"normalizer": {"type": "Lowercase"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}},
        {"pre_tokenizer": None},
        {"model": {"ignore_merges": True}},
        {"added_tokens": [token]},
    ):
        with pytest.raises(ValueError):
            bpe.Vocabulary.read(small_tokenizer(tmp_path, ["ab"], **changes))
    assert bpe.Vocabulary.read(small_tokenizer(tmp_path, ["ab"])).merges
