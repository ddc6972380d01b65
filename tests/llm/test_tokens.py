"""Token counts under edits, token files and packing, against whole-text encoding."""

import random
import re
import tracemalloc

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import packing, token_codec, token_counts, token_ids, words
from shelfwise.llm.packing import Limits, pack_documents
from shelfwise.llm.staging import new_path
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.token_ids import AddedParts, ByteLevelParts, WordParts, encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", " ", "  ", "\n", "'s", "é", "12", "!", "the ", "\t", " \n ", "don't", "x y", " ", "\x1c", "名", "Ünd.", "́"]


def tokenizer(path):
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


def mixed_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(80))) for _ in range(n)]


@pytest.mark.parametrize(("path", "kind"), [(BYTES, ByteLevelParts), (WORDS, WordParts)])
def test_parts_encode_as_the_whole(path, kind):
    texts, whole = mixed_texts(800), tokenizer(path)
    for row, ids in encoder(path, kind).documents(pa.array(texts)):
        assert ids.tolist() == whole.encode(texts[row], add_special_tokens=False).ids


def test_tree_follows_edits():
    rng, whole, count = random.Random(5), tokenizer(BYTES), encoder(BYTES, ByteLevelParts).count
    for text in [*mixed_texts(200, 3), "", "word " * 200]:
        leaves = token_counts.leaves_of(text)
        tree = token_counts.SegmentTree(leaves, [count(leaf) for leaf in leaves])
        for _ in range(6):
            start = rng.randrange(len(text) + 3)
            finish = start + rng.choice([-1, 0, 1, 3, 40])
            insert = "".join(rng.choice(BITS) for _ in range(rng.randrange(4)))
            tree.edit(start, finish, insert, count)
            a = min(start, len(text))
            text = text[:a] + insert + text[max(a, min(finish, len(text))) :]
            assert tree.n_tokens == len(whole.encode(text, add_special_tokens=False).ids)


def test_regions_equal_edits_in_turn():
    rng, whole, count = random.Random(6), tokenizer(BYTES), encoder(BYTES, ByteLevelParts).count
    for text in [*mixed_texts(150, 4), "", "word " * 200]:
        leaves = token_counts.leaves_of(text)
        tree = token_counts.SegmentTree(leaves, [count(leaf) for leaf in leaves])
        edits = []
        for _ in range(9):
            start = rng.randrange(len(text) + 2)
            finish = start + rng.choice([0, 1, 2, 30])
            edits.append({"start": start, "finish": finish, "insert": rng.choice([None, *BITS])})
        if rng.random() < 0.7:
            edits.sort(key=lambda e: -e["start"])
        for turn in token_counts.in_turns(edits, len(text)):
            for first, last, part in tree.regions(turn):
                tree.replace(first, last, part, count(part))
        for edit in edits:
            a = min(edit["start"], len(text))
            text = text[:a] + (edit["insert"] or "") + text[max(a, min(edit["finish"], len(text))) :]
        assert "".join(tree.texts) == text
        assert tree.n_tokens == len(whole.encode(text, add_special_tokens=False).ids)


def test_one_edit_encodes_little():
    count = encoder(BYTES, ByteLevelParts).count
    leaves = token_counts.leaves_of("some words of prose " * 500)
    tree = token_counts.SegmentTree(leaves, [count(leaf) for leaf in leaves])
    tree.edit(5000, 5003, "xyz", count)
    assert tree.encoded_leaves <= 2 < len(leaves) // 10


def test_counts_after_cleaning(docs, odd_rows):
    rows = [*odd_rows, (10, "mail me at a.b@c.org  or 0123456789 now!!!! ok"), (10, "mail me at a.b@c.org  or 0123456789 now!!!! ok"), (None, "x  y")]
    whole = tokenizer(BYTES)
    got = token_counts.cleaned_token_counts(docs(rows), BYTES).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in rows:
        assert by_id[i].n_tokens == len(whole.encode(text or "", add_special_tokens=False).ids)
    cleaned = "mail me at <email> or <number> now! ok"
    assert by_id[10].n_tokens_after == len(whole.encode(cleaned, add_special_tokens=False).ids) and by_id[10].n_edits == 4


def test_codec_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 5), (4095, 49408), (4096, 65536), (4097, 3), (9000, 49408)):
        ids = rng.integers(0, top, n).astype("<u4")
        payload = token_codec.to_payload(ids)
        assert (token_codec.from_payload(payload) == ids).all()
    repeated = np.tile(np.arange(50, dtype="<u4"), 400)
    assert len(token_codec.to_payload(repeated)) < len(repeated) // 4
    broken = bytearray(payload)
    broken[-40] ^= 255
    with pytest.raises(ValueError, match="damaged"):
        token_codec.from_payload(bytes(broken))


def test_token_files(docs, odd_rows, spark):
    rows = [*reversed(odd_rows), (30, "one two"), (30, "and more")]
    got = token_codec.coded_documents(docs(rows), new_path(spark, "codec-test"), WORDS)
    whole, at = tokenizer(WORDS), 0
    got = sorted(got.collect(), key=lambda r: r.start)
    for row, (i, text) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or "")), strict=True):
        ids = brute.token_ids(whole, text, 2)
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (i, at, len(ids), brute.crc(ids))
        at += len(ids)


@pytest.mark.parametrize("limits", [Limits(), Limits(tokens=64, segments=3, loss=40), Limits(tokens=50, segments=2, loss=50)])
def test_packing(docs, odd_rows, prose, limits):
    rows = [*odd_rows, *[(100 + k, prose(k % 37)) for k in range(120)], (None, "x")]
    got = pack_documents(docs(rows), BYTES, limits, with_ids=True).toPandas()
    whole = tokenizer(BYTES)
    for i, text in rows:
        own = got[got.doc_id == i] if i is not None else got[got.doc_id.isna()]
        own, at = own.sort_values("start"), 0
        ids = brute.token_ids(whole, text, 1)
        for piece in own.itertuples():
            part = ids[at : at + piece.length]
            assert (piece.start, piece.doc_tokens, piece.ids_crc32) == (at, len(ids), brute.crc(part))
            assert list(piece.ids) == part.tolist()
            at += piece.length
        assert at == len(ids)
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        total = int(pieces.length.sum())
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]]
        assert total <= limits.tokens and len(pieces) <= limits.segments
        assert (total == limits.tokens or total & (total - 1) == 0) and pieces.length.min() > 0
        loss = sum(max(0, p.start + p.length - max(p.start, 1)) for p in pieces.itertuples())
        assert loss <= limits.loss


def test_packing_bears_loss_after_the_prompt(docs, prose):
    rows = docs([(k, prose(60)) for k in range(30)]).selectExpr("*", "100L as prompt")
    got = pack_documents(rows, BYTES, Limits(512, 8, 100), loss_column="prompt").toPandas()
    for _, pieces in got.groupby("sequence_id"):
        assert sum(max(0, p.start + p.length - max(p.start, 100)) for p in pieces.itertuples()) <= 100


def test_empty_tables(docs, spark):
    none = docs([])
    assert pack_documents(none, BYTES).count() == 0
    assert token_codec.coded_documents(none, new_path(spark, "codec-test"), WORDS).count() == 0
    assert token_counts.cleaned_token_counts(none, BYTES).count() == 0


MARKED = [*BITS, "<|endoftext|>", "<|startoftext|>", "<|endoftext", "|>", "<|", "ENDOFTEXT|>"]


def marked_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(MARKED) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize(("path", "kind"), [(BYTES, AddedParts), (WORDS, WordParts)])
def test_added_tokens_encode_as_the_plain_call(path, kind):
    texts, plain = [*marked_texts(1500, 8), "ab <|endoftext|> cd", "ab  <|endoftext|>  cd "], Tokenizer.from_file(path)
    for row, ids in encoder(path, kind, True).documents(pa.array(texts)):
        assert ids.tolist() == plain.encode(texts[row], add_special_tokens=False).ids


def test_tree_follows_edits_of_added_tokens():
    rng, plain, count = random.Random(9), Tokenizer.from_file(BYTES), encoder(BYTES, AddedParts, True).count
    for text in [*marked_texts(150, 10), "word  <|endoftext|> " * 60]:
        starts = [0, *[k for k in range(1, len(text) - 1) if rng.random() < 0.3 and text[k] == " " and text[k + 1].isalpha() and text[k + 1].isascii()]]
        leaves = [text[a:b] for a, b in zip(starts, [*starts[1:], None])]
        tree = token_counts.SegmentTree(leaves, [count(leaf) for leaf in leaves])
        for _ in range(12):
            start = rng.randrange(len(text) + 1)
            finish, insert = min(len(text), start + rng.choice([0, 1, 3, 13, 40])), "".join(rng.choice(MARKED) for _ in range(rng.randrange(3)))
            tree.edit(start, finish, insert, count)
            text = text[:start] + insert + text[finish:]
            assert tree.n_tokens == len(plain.encode(text, add_special_tokens=False).ids)


def test_queries_encode_as_the_plain_call(docs, spark, tmp_path):
    text = "ab  <|endoftext|> cd<|startoftext|> e <<<<|endoftext|> f"
    docs([(1, text)]).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {path: Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids for path in (BYTES, WORDS)}
    (coded,) = QUERIES["op8_token_codec"](spark, str(tmp_path)).collect()
    assert coded.ids_crc32 == brute.crc(np.array([*ids[WORDS], 2], "<u4"))
    assert QUERIES["op1_token_counts"](spark, str(tmp_path)).first().n_tokens == len(ids[BYTES])
    assert QUERIES["op9_packing"](spark, str(tmp_path)).first().doc_tokens == len(ids[BYTES]) + 1


def test_long_runs_of_letters_are_scanned_once():
    """Time in proportion to the text, also where no address ends the run."""
    import time

    from shelfwise.llm.token_counts import CLEANING, _edits

    patterns = [(re.compile(p), to, needs) for p, to, needs in CLEANING]
    started = time.perf_counter()
    assert _edits("x" * 400_000 + " @ ", patterns) == []
    assert time.perf_counter() - started < 10
    found = _edits("y" * 100 + "@host.org", patterns)
    assert [(e["start"], e["finish"], e["insert"]) for e in found] == [(36, 109, "<email>")]


def test_cutting_a_document_copies_nothing():
    ids = memoryview(np.arange(1_000_000, dtype="<u4").tobytes())
    span = packing.Span(1, ids, 0, 1_000_000, 1)
    head, tail = span.split(2048)
    assert head.ids.obj is tail.ids.obj is ids.obj and (head.length, tail.length, tail.start) == (2048, 997_952, 2048)
    pieces = [s for sequence in packing.Packer(packing.Limits()).add(span) for s in sequence]
    assert len(pieces) == 1_000_000 // 2048 and all(p.length == 2048 for p in pieces)


def test_encoding_holds_little_besides_ids():
    text = pa.array(["some ordinary words of a text " * 600] * 400, pa.string())  # 7 MB
    encode = token_ids.Encoder(public_tokenizers.path("byte_bpe_50k.json"), token_ids.AddedParts, True)
    encode.count("some ordinary words of a text")
    words._POWERS.clear()
    tracemalloc.start()
    try:
        total = sum(len(ids) for _, ids in encode.documents(text))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 400 * encode.count("some ordinary words of a text " * 600)
    assert peak < 64 << 20
