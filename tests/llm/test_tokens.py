import glob
import hashlib
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from repo_pulse.llm import packing, token_files, transducer_bpe
from repo_pulse.llm.bpe import merges
from repo_pulse.llm.lexicon import Lexicon, compile_lexicon
from repo_pulse.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER
from repo_pulse.llm.scratch import new_path
from repo_pulse.llm.tokenizing import Encoder
from tests.llm.helpers import ODD, SCHEMA, documents, prose


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORD_TOKENIZER), Tokenizer.from_file(BYTE_TOKENIZER)


def plain(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'St  \n  é1!<|endoftext|>ΣıİẞDž漢", max_size=30)))
def test_cut_texts_encode_as_whole_texts(libraries, texts):
    import pyarrow as pa

    for path, library, drops in zip(
        (WORD_TOKENIZER, BYTE_TOKENIZER), libraries, (True, False), strict=True
    ):
        ids, ends = Encoder(path, drops).encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == [plain(library, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abZ'9._-<| é", max_size=20)))
def test_words_joined_by_blanks_encode_as_whole_texts(libraries, texts):
    import pyarrow as pa

    coder = Encoder(WORD_TOKENIZER, True)
    ids, ends = coder.encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert got == [plain(libraries[0], t) for t in texts]


def test_few_words_need_a_mark_between_them(libraries, monkeypatch):
    """Only words beyond ASCII, or with an apostrophe or `<`, are parted by a special token."""
    import pyarrow as pa

    coder, marked = Encoder(WORD_TOKENIZER, True), []
    own = coder._encode_new
    monkeypatch.setattr(coder, "_encode_new", lambda units: marked.extend(units) or own(units))
    text = "Over 12,5 dogs... don't jump (é) <b>  again_and-again!"
    ids, _ = coder.encode(pa.array([text]))
    assert ids.tolist() == plain(libraries[0], text)
    assert sorted(marked) == sorted(w.encode() for w in ("don't", "(é)", "<b>"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aBH~<'9.é\u0301\u0331İK\u0085 \n", max_size=20)))
def test_joined_words_encode_as_whole_texts(libraries, texts):
    import pyarrow as pa

    for path, library, drops in zip(
        (WORD_TOKENIZER, BYTE_TOKENIZER), libraries, (True, False), strict=True
    ):
        ids, ends = Encoder(path, drops).encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == [plain(library, t) for t in texts]


def test_few_units_behind_a_blank_need_a_mark(libraries, monkeypatch):
    """A blank before a unit parts it from the others, but for one with `<` or more white space."""
    import pyarrow as pa

    coder, marked = Encoder(BYTE_TOKENIZER, False), []
    own = coder._encode_new
    monkeypatch.setattr(coder, "_encode_new", lambda units: marked.extend(units) or own(units))
    text = "Over 12,5 dogs... don't jump (é) <b>  again_and-again! 's"
    ids, _ = coder.encode(pa.array([text]))
    assert ids.tolist() == plain(libraries[1], text)
    assert sorted(marked) == [b"  again_and-again!", b" <b>", b"Over"]


def test_words_that_differ_in_case_are_encoded_once(libraries, monkeypatch):
    import pyarrow as pa

    coder, asked = Encoder(WORD_TOKENIZER, True), []
    own = coder._encode_words
    monkeypatch.setattr(coder, "_encode_words", lambda units: asked.extend(units) or own(units))
    text = "Dog dog DOG É é <|StartOfText|>"
    ids, _ = coder.encode(pa.array([text]))
    assert ids.tolist() == plain(libraries[0], text)
    assert sorted(asked) == sorted(w.encode() for w in ("dog", "É", "é", "<|StartOfText|>"))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abthe'sdΣİéẞ1½漢<|endoftext|>", min_size=1, max_size=70)))
def test_merges_equal_the_library(libraries, units):
    units = [u.encode() for u in units]
    sizes, ids = transducer_bpe.encode_units(units, merges(WORD_TOKENIZER))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert got == [plain(libraries[0], u.decode()) for u in units]


@given(st.sets(st.binary(min_size=1, max_size=6)), st.sets(st.binary(min_size=1, max_size=6)))
def test_lexicon_numbers_its_words_and_no_others(known, others):
    ordered = sorted(known)
    sizes = np.ones(len(ordered), dtype=np.int64)
    lexicon = Lexicon(compile_lexicon(ordered, sizes, np.arange(len(ordered))))
    asked = ordered + sorted(others - known)
    data = np.frombuffer(b"".join(asked), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(w) for w in asked])]).astype(np.int64)
    assert lexicon.numbers(data, ends).tolist() == [*range(len(ordered))] + [-1] * (
        len(asked) - len(ordered)
    )


def test_lexicon_shares_suffixes():
    stems = [b"walk", b"talk", b"climb", b"jump"]
    ordered = sorted(s + e for s in stems for e in (b"", b"ed", b"er", b"ing", b"s"))
    lexicon = Lexicon(compile_lexicon(ordered, np.ones(20, dtype=int), np.arange(20)))
    assert len(lexicon.keys) < sum(map(len, ordered)) // 3


def test_transducer_round_trip(spark, libraries):
    rows = [*ODD, *((20 + i, prose(i, 300)) for i in range(20))]
    docs = documents(spark, rows)
    lexicon = transducer_bpe.build_lexicon(docs, WORD_TOKENIZER, size=50)
    got = transducer_bpe.encode_and_decode(docs, WORD_TOKENIZER, lexicon).collect()
    told = transducer_bpe.digests(docs, WORD_TOKENIZER, lexicon).collect()
    want = []
    for doc_id, text in rows:
        ids = plain(libraries[0], text)
        want.append((doc_id, len(ids), ids, libraries[0].decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    hashes = [
        (
            d,
            n,
            hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
        for d, n, ids, text in want
    ]
    assert sorted(map(repr, map(tuple, told))) == sorted(map(repr, hashes))


def test_token_files(spark, libraries):
    rows = [*ODD, *((100 - i, prose(i, 40)) for i in range(60))]
    path = new_path(spark, "test-token-files")
    token_files.write(documents(spark, rows), path, WORD_TOKENIZER, end_id=1)
    got = sorted(token_files.digests(spark, path).collect(), key=lambda r: r["start"])
    start, order = 0, []
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        order.append(r["doc_id"])
    numbers = [d for d in order if d is not None]
    assert order[:2] == [None, None] and numbers == sorted(numbers)
    want = [(d, len(i) + 1, crc([*i, 1])) for d, i in ((d, plain(libraries[0], t)) for d, t in rows)]
    told = [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got]
    assert sorted(map(repr, told)) == sorted(map(repr, want))
    some = token_files.read(spark, path, (50, 60)).select("doc_id", "ids").collect()
    assert {r["doc_id"] for r in some} == set(range(50, 61))
    plan = token_files.read(spark, path, (50, 60)).select("n_tokens")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "ids" not in text.split("ReadSchema")[1] and "GreaterThanOrEqual(doc_id" in text


def test_packing(spark, libraries):
    rows = [*ODD, *((100 + i, prose(i, 5 + 37 * i % 900)) for i in range(80))]
    docs = documents(spark, rows)
    limits = packing.Limits(tokens=1024, segments=8, loss_tokens=1000)
    got = packing.pack(docs, BYTE_TOKENIZER, 0, limits, prompt_tokens="row").collect()
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [
            sum(r["length"] for r in own[:i]) for i in range(len(own))
        ]
        assert len(own) <= 8 and sum(r["length"] for r in own) <= 1024
        assert sum(r["loss_tokens"] for r in own) <= 1000
        assert all(r["ids_crc32"] == crc(r["ids"]) and len(r["ids"]) == r["length"] for r in own)
    once = [(d, t) for d, t in rows if d not in (None, 5)]
    for doc_id, text in once:
        ids = [*plain(libraries[1], text), 0]
        own = sorted(pieces[doc_id, len(ids)], key=lambda r: r["start"])
        assert [x for r in own for x in r["ids"]] == ids
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert sum(r["loss_tokens"] for r in own) == max(len(ids) - 7, 0)
    total = sum(len(plain(libraries[1], t)) + 1 for _, t in rows)
    assert sum(r["length"] for r in got) == total


def test_packing_leaves_little_padding(spark):
    docs = documents(spark, [(i, prose(i, 10 + 13 * i % 400)) for i in range(300)]).coalesce(1)
    lengths = [
        r["n"]
        for r in packing.pack(docs, BYTE_TOKENIZER, 0)
        .groupBy("sequence_id")
        .agg({"length": "sum"})
        .withColumnRenamed("sum(length)", "n")
        .collect()
    ]
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in lengths)
    assert padding < 0.002 * sum(lengths)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    lexicon = transducer_bpe.build_lexicon(docs, WORD_TOKENIZER)
    assert transducer_bpe.digests(docs, WORD_TOKENIZER, lexicon).count() == 0
    assert packing.pack(docs, BYTE_TOKENIZER, 0).count() == 0
    path = new_path(spark, "test-no-tokens")
    token_files.write(docs, path, WORD_TOKENIZER, end_id=1)
    assert token_files.digests(spark, path).count() == 0


def test_files_are_ordered_by_number(spark):
    """With 100,000 files and more the names have six digits."""
    path = new_path(spark, "many-files")
    for number in (7, 99_999, 100_000):
        rows = spark.createDataFrame([(number, 2, [1, 2])], token_files.SCHEMA).coalesce(1)
        rows.write.parquet(f"{path}-{number}")
        [written] = glob.glob(f"{path}-{number}/part-*.parquet")
        os.makedirs(path, exist_ok=True)
        os.link(written, f"{path}/part-{number:05d}-x.c000.snappy.parquet")
    found = token_files.digests(spark, path).collect()
    assert {r.doc_id: r.start for r in found} == {7: 0, 99_999: 2, 100_000: 4}
