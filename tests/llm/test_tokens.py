"""Encoders against the libraries, ORC files, token counts."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from annospark.llm import bpe, token_counts, token_orc
from annospark.llm.text import flat

TEXTS = ["a  b", "a \n b", "\n x", "x\n", " lead", "trail ", "a　 b", "it's  WE'LL don't", "<|endoftext|> a<|endoftext|>", "", None, "x\t y ▁z ▁ ▁", "aaaaaaaaaaaaa", "....... -=-=", "naïve über 北京 🙂", "w" * 5000, "one two " * 4000, "<s> </s> <unk>"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "null id", "y"), (3, TEXTS[3], "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, token_ids string")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")


WHITE = [9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@pytest.mark.parametrize("kind", [bpe.TrieBPE, bpe.LibraryBPE])
def test_every_character_encodes_as_in_the_library(library, kind):
    own = kind(open(P.path("byte_bpe_50k.json"), "rb").read())
    texts = [f"{chr(c)}a{chr(c)}{chr(c)}1 {chr(c)}" for c in [*range(0x3100), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F400)]] + TEXTS
    texts += [f"{x}{chr(c)} b{chr(c)}é {chr(c)}«a" for c in WHITE for x in ("", "é", "a\xa0")]
    for some in (texts, texts[-1:], [""], []):
        ids, at = own.encode(*flat(pa.array(some, pa.string())))
        for t, a, b in zip(some, at.tolist(), at[1:].tolist()):
            assert (ids[a:b] == ids_of(library, t)).all() and b - a == len(ids_of(library, t)), t


def test_digests_and_arrays(spark, docs, library):
    for r in bpe.digest_tokens(docs, P.path("byte_bpe_50k.json")).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = ids_of(library, r.text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    rows = bpe.encode_documents(docs, P.path("byte_bpe_50k.json")).collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.decoded == (r.text or "") for r in rows)
    assert bpe.encode_documents(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_orc_round_trip(spark, docs, library, tmp_path):
    path = str(tmp_path / "orc")
    token_orc.write_tokens(docs, path, P.path("byte_bpe_50k.json"), 2, files=3)
    rows = token_orc.check_sums(token_orc.read_tokens(spark, path)).collect()
    texts = dict(enumerate(TEXTS)) | {None: "null id"}
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        ids = np.append(ids_of(library, texts[r.doc_id]), 2).astype("<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == sorted([r.doc_id for r in rows], key=lambda k: -1 if k is None else k)
    assert token_orc.look_up(spark, path, 5).count() == 1


def test_look_up_skips_row_groups(spark, tmp_path):
    docs = spark.range(6000).selectExpr("id * 2 AS doc_id", "repeat(concat('word ', id), 20) AS text")
    token_orc.write_tokens(docs, str(tmp_path / "orc"), P.path("byte_bpe_50k.json"), 2, files=2)

    def scanned(value):
        found = token_orc.look_up(spark, str(tmp_path / "orc"), value)
        n = found.count()
        plan = found._jdf.queryExecution().executedPlan()
        found.collect()
        while plan.children().size():
            plan = plan.children().head()
        return n, plan.metrics().apply("numOutputRows").value()

    n, read = scanned(5000)
    assert n == 1 and 0 < read <= token_orc.INDEX_ROWS
    assert scanned(5001) == (0, 0)  # within the range, ruled out by the Bloom filter


def test_summaries_merge_over_many_tasks(spark):
    docs = spark.range(4000).selectExpr("concat('word', id % 50, ' other ▁x') AS text").repartition(40)
    assert set(token_counts.frequent_units(docs)) == {f"word{i}" for i in range(50)} | {"other", "▁x"}


def test_counts_equal_sentencepiece(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in token_counts.count_tokens(docs, P.path("piece_bpe_32k.model"), limit=100).collect()}
    for i, t in enumerate(TEXTS):
        n = len(model.encode(t or ""))
        assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit) == (n, len((t or "").encode()), n > 100), t
    assert token_counts.count_tokens(docs.limit(0), P.path("piece_bpe_32k.model")).count() == 0
