import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strata.llm import binary_tokens, packing
from strata.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a<|endoftext|>b c", "d\x1ce é é 'S don't ÀÉ İx ΑΣ", "x y\x85z 　日本語 12ab", "we'll,they're!!", "ß×÷ß\tü\r\nö", "'s 't"]


def whole(texts):
    t = Tokenizer.from_file(PATH)
    return [np.asarray(t.encode(x, add_special_tokens=False).ids, "<u4") for x in texts]


def test_chunks_give_the_library_ids(texts):
    every = [*texts, *ODD]
    encoder = Encoder(PATH)
    for _ in range(2):  # the second time from the cache
        assert [encoder.encode(t) for t in every] == [w.tobytes() for w in whole(every)]


def test_binary_files_round_trip(spark, frame, rows, tmp_path):
    path = str(tmp_path / "corpus")
    data = [*rows, (None, "no id"), *((2000 + i, t) for i, t in enumerate(ODD))]
    shards = binary_tokens.write(frame(data), path, PATH, end_id=2, partitions=4)
    got = {}
    for r in binary_tokens.read(spark, path, shards).orderBy("start").collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["ids_crc32"]))
    at, ordered = 0, sorted(data, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    for (i, _), ids in zip(ordered, whole([t or "" for _, t in ordered])):
        ids = np.append(ids, 2).astype("<u4")
        assert got[i].pop(0) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert sum(r["n_tokens"] for r in shards.collect()) == at
    empty = binary_tokens.write(frame([]), path + "0", PATH, end_id=2, partitions=2)
    assert binary_tokens.read(spark, path + "0", empty).count() == 0


def test_rows_without_an_id_are_spread_over_shards(spark, frame, tmp_path):
    data = [(None, f"text number {i}") for i in range(300)] + [(7, f"of one id {i}") for i in range(300)] + [(9, "last")]
    path = str(tmp_path / "corpus")
    shards = binary_tokens.write(frame(data), path, PATH, end_id=2, partitions=6)
    assert max(r["n_docs"] for r in shards.collect()) < 200
    got = binary_tokens.read(spark, path, shards).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 300 + [7] * 300 + [9]
    want = {zlib.crc32(np.append(ids, 2).astype("<u4").tobytes()) for ids in whole([t for _, t in data])}
    assert {r["ids_crc32"] for r in got} == want


def best_fit(lengths, capacity):
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
            n += 1
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.randint(1, 40)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        histogram = {x: lengths.count(x) for x in set(lengths)}
        used, seen = {}, dict.fromkeys(histogram, 0)
        for length, first, stop, each, start, offset in packing.plan(histogram, capacity):
            assert first == seen[length]
            seen[length] = stop
            for k in range(stop - first):
                used.setdefault(start + k // each, []).append((offset + k % each * length, length))
        assert seen == histogram
        for items in used.values():
            end = 0
            for offset, length in sorted(items):
                assert offset == end
                end += length
        assert sorted(capacity - sum(n for _, n in items) for items in used.values()) == best_fit(lengths, capacity)


def test_packed_pieces(frame, rows):
    pieces = packing.token_pieces(frame(rows), PATH, end_id=1, capacity=64, with_ids=True)
    got = packing.pack(pieces, 64).collect()
    texts = {i: np.append(x, 1).astype("<u4") for (i, _), x in zip(rows, whole([t or "" for _, t in rows]))}
    bins = {}
    for r in got:
        ids = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == r["piece"] * 64 and len(ids) == r["length"]
        assert bytes(r["ids"]) == ids.tobytes() and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in got) == sum(len(texts[i]) for i, _ in rows)
    for items in bins.values():
        ends = [a + n for a, n in sorted(items)]
        assert [a for a, _ in sorted(items)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert len(bins) == len(best_fit([r["length"] for r in got], 64))
    assert packing.pack(packing.token_pieces(frame([]), PATH, 1, 64), 64).count() == 0
