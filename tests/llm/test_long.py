"""Very long texts of one kind of character in every operator."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.test_operators import SF
from wardgraph.llm import chat, tokens
from wardgraph.llm.queries import QUERIES

N = 3_000_000
LONG = [" " * N, "\n" * N, "a" * N, "!" * N, "x" + " \n\t" * (N // 3) + "y", " " * N + "the end"]


def test_parts_are_the_text_and_end_where_pieces_do():
    run = " " * tokens.LONG_RUN
    for text, want in [("a" + run + " b", ["a", run, " b"]), (run, [run]), (run[1:] + "b", [run[1:] + "b"]), ("a" + run + chat.STOP, ["a", run, chat.STOP]), (run + "\x1cb" + run, [run[1:], " \x1cb", run])]:
        got = list(tokens.stretches(text, (chat.STOP,)))
        assert [p for p, _ in got] == want and all(whole == (not p.strip(" ") and len(p) > 9) for p, whole in got)


@pytest.mark.parametrize("run", [" " * 1_000_000, "\n" * 400_000, "\n 　\t" * 100_000, "a" * 300_000, "?" * 300_000])
def test_ids_are_the_plain_tokenizers(run):
    own, whole, byte = chat._loaded(chat.TOKENIZER), chat.tokenizer(chat.TOKENIZER), tokens.loaded(tokens.ByteBpe, tokens.BYTE_BPE)
    for text in [run, "é" + run + "b", run + "\n!", chat.render([("user", run), ("assistant", "x" + run + " y")])[0]]:
        want = whole.encode(text, add_special_tokens=False)
        ids, offsets = own.encode(text)
        assert ids.tolist() == want.ids and (offsets == np.array(want.offsets)).all()
        if "<|" not in text:  # one vocabulary, in two formats
            assert np.frombuffer(byte.encode(text), "<u2").tolist() == want.ids


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("long")
    for name in ("documents", "benchmark", "labels", "conversations"):
        table = pq.read_table(f"{SF}/{name}.parquet").slice(0, 60)
        if name == "documents":
            more = [{"doc_id": 1000 + i, "text": t, "lang": None, "source": "s", "n_chars": len(t)} for i, t in enumerate(LONG)]
        elif name == "conversations":
            more = [{"conv_id": 1000 + i, "turn": k, "role": r, "text": t} for i, t in enumerate(LONG) for k, r in ((0, "user"), (1, "assistant"))]
        else:
            more = []
        pq.write_table(pa.concat_tables([table, pa.Table.from_pylist(more, table.schema)]) if more else table, at / f"{name}.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["op1_language_id", "op2_decontaminate", "op4_secrets", "op9_near_dedup", "op10_quality"])
def test_long_documents(spark, folder, name):
    rows = {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}
    assert len(rows) == 60 + len(LONG)
    if name == "op1_language_id":
        assert rows[1000].lang_pred == rows[1003].lang_pred == "und"
    if name == "op2_decontaminate":
        assert [rows[1000 + i].n_words for i in range(6)] == [0, 0, 1, 0, 2, 2] and not any(rows[1000 + i].contaminated for i in range(6))
    if name == "op9_near_dedup":
        assert [rows[1000 + i].n_shingles for i in range(6)] == [0, 0, 1, 1, 1, 1]


def test_long_documents_are_packed(spark, folder):
    word = tokens.loaded(tokens.WordBpe, tokens.WORD_BPE)
    rows = [r for r in QUERIES["op5_pack"](spark, folder).where("doc_id >= 1000").collect()]
    for i, text in enumerate(LONG):
        mine = sorted((r for r in rows if r.doc_id == 1000 + i), key=lambda r: r.start)
        ids = word.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert sum(r.length for r in mine) == len(ids) == mine[0].doc_tokens
        assert all(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in mine)


def test_long_documents_in_training_order(spark, folder):
    byte = tokens.loaded(tokens.ByteBpe, tokens.BYTE_BPE)
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    rows = QUERIES["op6_training_order"](spark, folder).select("slot", "tokens").collect()
    assert sum(r.tokens for r in rows) == sum(len(byte.encode(t)) // 2 + 1 for t in texts)
    assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_long_conversations(spark, folder):
    rows = {r.conv_id: r for r in QUERIES["op7_chat_format"](spark, folder).where("conv_id >= 1000").collect()}
    for i, text in enumerate(LONG):
        assert rows[1000 + i].n_turns == 2 and rows[1000 + i].loss_chars == len(text)
        assert rows[1000 + i].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
        assert rows[1000 + i].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_lexical", "op13_spelling"])
def test_long_documents_are_searched(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    assert rows and not any("aaaaaaa" in (r.word if name == "op13_spelling" else "") for r in rows)
