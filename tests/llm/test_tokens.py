from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.helpers import empty, frame, odd_rows
from tripmart.llm import bitplanes, bpe, packing
from tripmart.llm.tables import shared_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", ",", ".", "²", "_", "٣", "é", " ", "  ", "\n", "é", "语", "!!", "aaaa", "'s", " ", "7", "the", "\t \t", "🙂", "ing", "Ж", " \x1c", "　"]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_same_ids_as_the_library(tiktoken_encoding):
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for text in texts(1500):
        ids = tiktoken_encoding.encode_ordinary(text)
        assert own.encode(text) == ids
        assert own.decimal(text) == ",".join(map(str, ids)).encode()
        assert own.decode(own.decimal(text)) == text.encode()


def test_prefixes_append_and_edit():
    vocabulary = bpe.Vocabulary.from_file(RANKS)
    rng = random.Random(2)
    for text in texts(300, 3):
        data = text.encode()
        cut = rng.randint(0, len(data))
        table = bpe.Prefixes(vocabulary, data[:cut])
        table.append(data[cut:])
        assert table.last == bpe.Prefixes(vocabulary, data).last
        start = rng.randint(0, len(data))
        table.edit(start, stop := rng.randint(start, len(data)), b"zq the")
        assert table.data == data[:start] + b"zq the" + data[stop:]
        assert table.last == bpe.Prefixes(vocabulary, table.data).last
    long = bpe.Prefixes(vocabulary, b" the cat sat on the mat" * 200)
    assert long.edit(1000, 1003, b"dog") < 200  # the rest is taken over


def test_bpe_of_odd_rows(spark, tiktoken_encoding):
    out = bpe.round_trip(frame(spark), RANKS, public_tokenizers.PATTERN).collect()

    def row(doc_id, text):
        ids = tiktoken_encoding.encode_ordinary(text or "")
        joined = ",".join(map(str, ids))
        return doc_id, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), joined, (text or "").encode()

    assert Counter((*tuple(r)[:5], bytes(r["decoded"])) for r in out) == Counter(row(*r[:2]) for r in odd_rows())
    assert bpe.round_trip(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_pieces_give_the_same_ids_as_whole_texts():
    for path, spaces in ((WORDS, False), (BYTES, True)):
        tokenizer, cache = Tokenizer.from_file(path), packing._ids_of(path, spaces)
        for text in texts(1500, 4):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert cache.of(text) == np.array(ids, "<u4").tobytes(), text


def test_piece_cache_starts_again():
    cache = packing.PieceCache(lambda xs: [x.encode() for x in xs], kept=3, between=b"|")
    assert cache.of("a b c d e f g") == b"a| b| c| d| e| f| g"
    assert cache.of("h b") == b"h| b"
    assert cache.of("a, b.\nc d.e") == b"a|,| b|.|\n|c| d.e"
    assert len(cache.ids) <= 16 and cache.older


def naive_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= length]
        if fits:
            best = min(fits, key=lambda k: rooms[k])
            rooms[best] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([1, 7, 10, 64, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        runs = packing.plan(Counter(lengths), capacity)
        used: dict[int, int] = {}
        places = set()
        for run in runs:
            for rank in range(run.first_rank, run.end_rank):
                sequence, nth = divmod(rank - run.first_rank, run.per_sequence)
                offset = run.offset + nth * run.length
                sequence += run.first_sequence
                for at in range(offset, offset + run.length):
                    assert (sequence, at) not in places
                    places.add((sequence, at))
                used[sequence] = used.get(sequence, 0) + run.length
        assert sum(used.values()) == sum(lengths)
        assert sorted(capacity - x for x in used.values()) == naive_best_fit(lengths, capacity)


def test_packing_of_odd_rows(spark):
    packed = packing.pack(frame(spark), WORDS, capacity=16)
    rows = packed.collect()
    tokenizer = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc_id, text, *_ in odd_rows():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for n, start in enumerate(range(0, len(ids), 16)):
            piece = ids[start : start + 16]
            expected[doc_id, n, start, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    ends: dict[int, int] = {}
    for row in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == ends.get(row["sequence_id"], 0)
        ends[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(ends.values()) <= 16
    assert packing.pack(empty(spark), WORDS).count() == 0


def test_sequences_hold_their_documents(spark):
    df = frame(spark, [(k, f"text number {k} " * k, "en", "a", 1) for k in range(1, 30)], clash=False)
    packed = packing.pack(df, WORDS, capacity=40)
    made = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(df, packed, WORDS, capacity=40).collect()}
    for row in packed.collect():
        part = made[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]]
        assert zlib.crc32(part.tobytes()) == row["ids_crc32"]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_and_any_range_of_a_file(kind):
    rng = np.random.default_rng(1)
    documents = [rng.integers(0, 2**32, n, dtype=np.uint64).astype("<u4") for n in (0, 3, 100, 1, 17, 0, 64)]
    stream = io.BytesIO()
    writer = bitplanes.Writer(stream, kind, block_ids=16)
    for k, ids in enumerate(documents):
        writer.add(None if k == 2 else k, ids.tobytes())
    writer.close()
    reader = bitplanes.Reader(io.BytesIO(stream.getvalue()))
    whole = np.concatenate(documents)
    assert reader.documents == [0, 1, None, 3, 4, 5, 6]
    for start in range(0, len(whole), 7):
        for stop in range(start, len(whole), 11):
            assert (reader.ids(start, stop) == whole[start:stop]).all()
    for (_, parts), ids in zip(reader.each(), documents):
        assert b"".join(p.tobytes() for p in parts) == ids.tobytes()
    with pytest.raises(ValueError):
        bitplanes.Reader(io.BytesIO(stream.getvalue()[:-1] + b"x"))


def test_files_of_odd_rows(spark):
    tokenizer = Tokenizer.from_file(BYTES)
    for kind in ("byte", "bit"):
        rows = bitplanes.round_trip(frame(spark), BYTES, kind=kind).collect()
        expected, start = [], 0
        for doc_id, text, *_ in sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected
    assert bitplanes.round_trip(empty(spark), BYTES).count() == 0


def test_one_id_on_all_rows_is_dealt_to_many_tasks(spark):
    rows = [(5, "copies of one row " * 20, "en", "a", 1)] * 3000 + [(5, f"text {k}", "en", "a", 1) for k in range(3000)]
    df = frame(spark, rows, clash=False).repartition(8)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        files = bitplanes.write_ids(df, BYTES, shared_folder(spark)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(f["n_docs"] for f in files) == 6000 and len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(f["n_docs"] for f in files) < 3000
    out = bitplanes.round_trip(df, BYTES).collect()
    starts = sorted((r["start"], r["n_tokens"]) for r in out)
    assert len(out) == 6000 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_copies_of_one_row_are_ranked_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 50)
    df = frame(spark, [(None, "the same text", "en", "a", 1)] * 2000 + [(None, f"text {k}", "en", "a", 1) for k in range(100)], clash=False)
    out = packing.pack(df, WORDS, capacity=64).collect()
    used: dict[int, list] = {}
    for row in out:
        used.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in used.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 64
    assert len(out) == 2100 and len(used) == len(naive_best_fit([r["length"] for r in out], 64))


def test_letters_that_a_normalizer_takes_apart():
    letters = [chr(c) for c in range(0x30000) if chr(c).isalnum() and not 0xD800 <= c < 0xE000]
    given = [f"a{c}, d a{c}.\nb{c} {c}x. {c}" for c in letters]
    for path, spaces in ((WORDS, False), (BYTES, True)):
        own = packing.token_ids(pa.array(given), path, spaces, 0)
        for text, ids, whole in zip(given, own, Tokenizer.from_file(path).encode_batch_fast(given, add_special_tokens=False)):
            assert ids[:-4] == np.array(whole.ids, "<u4").tobytes(), text


def test_runs_of_white_space():
    rng = random.Random(9)
    parts = ["a", "the", "Word", ",", "'s", "7", "  ", "\n\n", "\t", " ", "\n", "\r\n", "!!", "é", "\x0b", " \n ", "\x0c ", "\x1c"]
    given = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    own = packing.token_ids(pa.array(given), BYTES, True, 0)
    for text, ids, whole in zip(given, own, Tokenizer.from_file(BYTES).encode_batch_fast(given, add_special_tokens=False)):
        assert ids[:-4] == np.array(whole.ids, "<u4").tobytes(), text


def test_new_words_beside_white_space_and_marks():
    """Ids of new words are the library's, whether or not pieces of a batch hold white space, line breaks or marks."""
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from tripmart.llm import packing

    texts = ["one two", "a.b one. two,, three.\nfour five,six", "  wide\n\n gap | x|y |", "\n", " ", "", "sev.en .. ,", "one", "\x00 nul"]
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        plain = Tokenizer.from_file(path)
        for batch in (texts, *([x] for x in texts), texts[:2]):
            packing._ids_of.cache_clear()
            found = [np.frombuffer(x, "<u4").tolist() for x in packing.token_ids(pa.array(batch), path, spaces, 7)]
            assert found == [[*plain.encode(x, add_special_tokens=False).ids, 7] for x in batch]


def test_words_alone_are_given_to_the_model():
    """Words of plain letters come to the model as the library's other steps leave them; ids are the library's."""
    rng = random.Random(12)
    letters = packing.LETTERS
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(2000)]
    marks = ["", ".", ",,", "!!", "&&&", ".###", "$$$", "%", "***", ".\nNext", "!!\nNext", "'s", "-1", "7", "_", " \u0301"]
    given = [" ".join(w + rng.choice(marks) for w in rng.choices(words, k=8)) for _ in range(500)]
    for path, spaces in ((WORDS, False), (BYTES, True)):
        library, batch = Tokenizer.from_file(path), packing.Batch(Tokenizer.from_file(path), "\n" if spaces else " | ")
        alone = [*words, *(" " + w for w in words if spaces)]
        batch._marked = None  # not needed for words
        assert [np.frombuffer(x, "<u4").tolist() for x in batch(alone)] == [library.encode(x, add_special_tokens=False).ids for x in alone]
        packing._ids_of.cache_clear()
        for text, ids in zip(given, packing.token_ids(pa.array(given), path, spaces, 7)):
            assert np.frombuffer(ids, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 7], text


def test_words_that_a_tokenizer_splits_are_left_to_it():
    from tokenizers.pre_tokenizers import Sequence, Split

    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.pre_tokenizer = Sequence([Split("e", "isolated"), tokenizer.pre_tokenizer])
    assert packing.Batch(tokenizer, "\n").table is None


def test_few_known_pieces():
    """A worker that keeps few pieces gives the same ids."""
    rng = random.Random(13)
    given = pa.array([" ".join("".join(rng.choices(packing.LETTERS, k=6)) for _ in range(10)) for _ in range(1000)])
    packing._ids_of.cache_clear()
    few = list(packing.token_ids(given, WORDS, False, 1, known=500))
    cache = packing._ids_of(WORDS, False, 500)
    # what 200 texts have is looked up at once
    assert cache.kept == 500 and max(len(cache.ids), len(cache.older)) <= 500 + 2000
    assert few == list(packing.token_ids(given, WORDS, False, 1))
    packing._ids_of.cache_clear()
