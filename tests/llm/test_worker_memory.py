"""What Python workers hold between and within operators."""

import subprocess
import sys

import public_tokenizers
import pytest

from teletally.llm import bpe, mixing, order_minhash
from teletally.llm.common import small_table
from tests.llm.cases import docs

# A tool of 200 MB below something that stays, as a worker's C library finds it.
DROPPED = """
import os
from teletally.llm import common

def megabytes():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

before = megabytes()
common.worker_tool("blocks", lambda: [bytes(2000) for _ in range(100_000)])
stays = [bytes(2000) for _ in range(1000)]
held = megabytes()
common.drop_tool()
print(held - before, megabytes() - before)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_dropped_tool_goes_back_to_the_system():
    run = subprocess.run([sys.executable, "-c", DROPPED], capture_output=True, text=True, check=True, timeout=120)
    held, left = map(float, run.stdout.split())
    assert held > 150
    assert left < 50


def test_a_piece_of_one_part_is_kept_once():
    encoder = bpe.Encoder(bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")), bpe.ids_form)
    plain = bpe.Encoder(bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")))
    text = "one unlikelyword, another unlikelyword twice"
    for _ in range(2):
        assert b"".join(encoder.pieces(text)) == b"".join([i.to_bytes(4, "little") for i in plain.encode(text)])
    assert " another" in encoder._pieces and " another" not in encoder._parts_seen
    # Before a sign it is a part as well.
    assert " unlikelyword" in encoder._parts_seen and "," in encoder._parts_seen
    assert all(isinstance(form, bytes) for form in encoder._pieces.values())


def test_full_tables_change_no_id(monkeypatch):
    whole = bpe.Encoder(bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")))
    for name in ("PIECES", "PARTS", "PAIRS"):
        monkeypatch.setattr(bpe, name, 3)
    small = bpe.Encoder(bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")))
    for text in ("a b, c. d! unlikelyword's  two\n words", "a b, c. d!", "unlikelyword, unlikelyword"):
        assert small.encode(text) == whole.encode(text)
    assert max(len(small._pieces), len(small._parts_seen), len(small._separates)) <= 3


def test_ids_of_more_rows_than_a_slice(spark, monkeypatch):
    rows = [(k, " ".join(["word"] * (k % 7)) if k % 5 else None) for k in range(1201)]
    found = bpe.encode(docs(spark, rows, partitions=1), public_tokenizers.path("byte_bpe_50k.json")).collect()
    encoder = bpe.Encoder(bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")))
    expected = [(k, encoder.encode(text or "")) for k, text in rows]
    assert sorted((r.doc_id, r.ids) for r in found) == expected
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in found)


def test_rows_of_the_driver_need_no_python_worker(spark):
    """A scan of Python rows is planned as ExistingRDD."""
    table = docs(spark, [(k, f"text {k}") for k in range(9)]).localCheckpoint()  # its own rows leave the plan
    own = table._jdf.queryExecution().toString().count("ExistingRDD")
    found = mixing.mix(spark.createDataFrame(table.toArrow()))._jdf.queryExecution().toString()
    assert own and "ExistingRDD" not in found


def test_small_table(spark):
    rows = [("a", 1, b"x"), (None, None, None), ("b", 2**40, b"")]
    found = small_table(spark, rows, "name string, n long, raw binary")
    assert found.dtypes == [("name", "string"), ("n", "bigint"), ("raw", "binary")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)
    assert small_table(spark, [], "name string").collect() == []


def test_near_duplicates_without_any_link(spark):
    found = order_minhash.near_duplicates(docs(spark, [(1, "one two three four five six"), (2, "other words than these here now")]))
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found.collect()) == [(1, 1, True), (2, 2, True)]
