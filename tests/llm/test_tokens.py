import itertools
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loomstep.llm import packing, token_shards, tokens
from loomstep.llm.queries import vocabulary
from loomstep.llm.tokens import END, WordTokenizer


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(vocabulary())


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, END]


ODD = ["it's can't 'S DON'T", "İstanbul ΣΑΣ Σ. ΑΣ", "é Å ﬁ", "a b c\u0085d", "12 3a4.5,6!!?", "<|endoftext|> x", "​﻿z \x1c y", "中文 かな 한글", "trash.TRASH, Trash"]


def test_words_in_a_row_are_the_whole_text(whole, edge):
    texts = ODD + [r["text"] for r in edge.collect()]
    own = WordTokenizer(vocabulary(), cache_runs=50)
    for _ in range(2):
        ids, sizes = own.encode(pa.array(texts, pa.string()))
        at = np.split(ids, np.cumsum(sizes)[:-1])
        for t, got in zip(texts, at):
            assert got.tolist() == ids_of(whole, t), t


def test_letter_runs_need_no_normaliser(whole):
    """Each plain letter, alone and in a run, with and without a tail, in both cases; the normalising tokenizer is not asked."""
    letters = [c for k in range(0xD7A4) if re.match(tokens.PLAIN, c := chr(k))]
    runs = [*letters, *("".join(letters[k : k + 9]) for k in range(0, len(letters), 7)), "ÀÉß", "ЖЁй", "ΣΑΣ", "Ÿž"]
    texts = [f"{r} {r.swapcase() if r.isascii() else r}.,) ab{r}" for r in runs]
    own = WordTokenizer(vocabulary())
    own.encode(pa.array(["a.,)"]))
    own.tokenizer = None
    ids, sizes = own.encode(pa.array(texts))
    for t, got, want in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), whole.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == [*want.ids, END], t


def test_runs_that_come_again_outlive_a_full_cache(whole):
    own = WordTokenizer(vocabulary(), cache_runs=50)
    say = lambda k: pa.array([f"Often, seen {' '.join('x' + chr(97 + i % 26) * (2 + i // 26) for i in range(k, k + 30))}"])
    for k in (0, 30, 60):
        ids, _ = own.encode(say(k))
        assert ids.tolist() == ids_of(whole, say(k)[0].as_py())
    more = pa.array([None, "", " \n", "a  b "])
    for _ in range(2):
        assert own.encode(more)[0].tolist() == [END, END, END, *ids_of(whole, "a b")]
    assert len(own.place) < 50
    own = WordTokenizer(vocabulary(), cache_runs=50)
    for texts in (say(0), say(30), more):
        own.encode(texts)
    assert {"often", ",", "seen", "a", "b"} <= own.place.keys() and len(own.place) < 50


def test_long_runs_take_bounded_memory(whole):
    """Where no space parts words, runs are sentences that never come again: neither the cache nor one call of the tokenizer holds many ids."""
    rng, own, asked = random.Random(5), WordTokenizer(vocabulary()), []

    class Asked:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **how):
            asked.append(sum(map(len, texts)))
            return self.tokenizer.encode_batch_fast(texts, **how)

    own.plain = Asked(own.plain)
    say = lambda: " ".join("".join(map(chr, rng.choices(range(0x4E00, 0x5300), k=40))) for _ in range(15_000))
    for _ in range(4):
        ids, _ = own.encode(pa.array([text := say()]))
        assert own.used <= tokens.CACHE_IDS + len(ids) and own.used == own.size[: len(own.place)].sum()
    assert ids.tolist() == ids_of(whole, text)
    assert max(asked) <= 16 * 512 * 41 < len(text)
    ids, _ = own.encode(pa.array(["seen , seen"]))
    assert ids.tolist() == ids_of(whole, "seen , seen") and own.used < 100


def test_a_mark_that_lower_case_brings_joins_its_tail(whole):
    ids, _ = WordTokenizer(vocabulary()).encode(pa.array(["İ? oİ.,", "Kİ, x"], pa.string()))
    assert ids.tolist() == ids_of(whole, "İ? oİ.,") + ids_of(whole, "Kİ, x")


def test_slices_are_encoded_together(whole, monkeypatch):
    own, asked = WordTokenizer(vocabulary()), []
    monkeypatch.setattr(own, "encode", lambda texts, encode=own.encode: asked.append(len(texts)) or encode(texts))
    texts = [None, "", "one two", "three " * 400, "four", None, "x " * 3000, "five six", "", "seven"]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], ["t"]) for t in (texts[:4], [], texts[4:5], texts[5:])]
    monkeypatch.setattr(tokens, "ENCODED_BYTES", 3000)
    got = list(own.encode_slices(batches, 0, 1000))
    assert [t for x, _, _ in got for t in x.column(0).to_pylist()] == texts and max(x.num_rows for x, _, _ in got) > 1
    for x, ids, sizes in got:
        assert ids.tolist() == [i for t in x.column(0).to_pylist() for i in ids_of(whole, t)] and len(sizes) == x.num_rows
    assert asked == [6, 1, 3] and len(got) > len(asked)
    assert list(own.encode_slices([], 0, 10)) == []


def test_pieces_cover_all_ids(whole, edge, clashing, empty):
    got = packing.pack(clashing, vocabulary(), window=256).collect()
    want = sorted((str(r["doc_id"]), len(ids_of(whole, r["text"])), zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for r in edge.collect() for x in [ids_of(whole, r["text"])])
    docs, seqs, at = [], {}, {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == seqs.get(r["sequence_id"], 0) and r["length"] * 4 == len(r["ids"])
        seqs[r["sequence_id"]] = r["offset"] + r["length"]
        if r["start"] == 0:
            docs.append([str(r["id"]), r["doc_tokens"], b""])
            at[str(r["id"]), r["doc_tokens"]] = docs[-1]
        mine = at[str(r["id"]), r["doc_tokens"]]  # order is preserved, so the next piece is of the latest such document
        assert r["start"] * 4 == len(mine[2])
        mine[2] += r["ids"]
    assert sorted((i, n, zlib.crc32(b)) for i, n, b in docs) == want
    assert max(seqs.values()) <= 256
    assert packing.pack(empty, vocabulary()).count() == 0


def test_cuts_are_the_best(whole):
    rng = random.Random(2)
    for _ in range(60):
        n, window = rng.randint(1, 11), rng.randint(6, 20)
        at = np.r_[0, np.cumsum([rng.randint(1, 6) for _ in range(n)])]
        penalty = np.array([0] + [rng.choice([0, 2, 5]) for _ in range(n)], float)
        cost = lambda ends: sum(window - (b - a) for a, b in itertools.pairwise([0, *ends])) + sum(penalty[list(at).index(e)] for e in ends)
        able = [[*c, at[-1]] for k in range(n) for c in itertools.combinations(at[1:-1], k) if all(b - a <= window for a, b in itertools.pairwise([0, *c, at[-1]]))]
        assert cost(packing.best_cuts(at, penalty, window)) == min(map(cost, able))


def test_little_padding(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = packing.pack(df, vocabulary()).groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert got.sum() / (4096 * len(got)) > 1 - 0.01 - 4096 / got.sum()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    got = token_shards.feistel(np.arange(n), n)
    assert sorted(got.tolist()) == list(range(n))
    if n > 60:
        assert np.abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.4 and (token_shards.feistel(np.arange(n), n, key=1) != got).any()


def test_shards_round_trip(whole, edge, clashing, empty, tmp_path):
    path = f"file://{tmp_path}/shards"
    manifest = token_shards.write_token_shards(clashing, vocabulary(), path, length=64, per_shard=50).orderBy("slot").collect()
    assert [r["slot"] for r in manifest] == list(range(len(manifest)))
    ids = token_shards.read_slots(path, 0, len(manifest), length=64, per_shard=50)
    assert len(ids) == len(manifest)
    assert [zlib.crc32(x.tobytes()) for x in ids] == [r["crc32"] for r in manifest]
    assert (token_shards.read_slots(path, 37, 40, length=64, per_shard=50) == ids[37:77]).all()
    order = sorted(manifest, key=lambda r: r["sequence"])
    assert [r["sequence"] for r in order] == list(range(len(order)))
    back = [i for r in order for i in ids[r["slot"]][: r["n_tokens"]].tolist()]
    texts, at = [ids_of(whole, r["text"]) for r in edge.collect()], 0
    assert sorted(back) == sorted(i for x in texts for i in x)
    rest = sorted(map(tuple, texts))
    while at < len(back):  # documents in a row, each closed
        end = back.index(END, at) + 1
        while tuple(back[at:end]) not in rest:
            end = back.index(END, end) + 1
        rest.remove(tuple(back[at:end]))
        at = end
    assert not rest
    assert token_shards.write_token_shards(empty, vocabulary(), f"file://{tmp_path}/none").count() == 0


def test_small_batches_are_tokenised_together(whole, edge, monkeypatch):
    own, asked, runs = WordTokenizer(vocabulary()), [], []
    monkeypatch.setattr(own, "encode", lambda texts, encode=own.encode: asked.append(len(texts)) or encode(texts))
    monkeypatch.setattr(token_shards, "tokenizer", lambda path: own)
    monkeypatch.setattr(token_shards.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    monkeypatch.setattr(type(edge), "mapInArrow", lambda self, run, schema: runs.append(run))
    token_shards.sequences(edge, vocabulary(), "doc_id", "text", 16)
    texts = [f"of {k} words" for k in range(40)]
    rows = [r for b in runs[0](pa.record_batch([[k], [t]], ["id", "text"]) for k, t in enumerate(texts)) for r in b.to_pylist()]
    got = [i for r in rows for i in np.frombuffer(pa.Codec(*token_shards.CODEC).decompress(r["ids"], 32), "<u2")[: r["n_tokens"]].tolist()]
    assert asked == [40] and got == [i for t in texts for i in ids_of(whole, t)]
    assert [r["place"] for r in rows] == list(range(len(rows))) and {k for r in rows for k in r["docs"]} == set(range(40))


def test_a_vocabulary_too_large_is_refused(edge, monkeypatch, tmp_path):
    class Large:
        ends = np.zeros((1 << 16) + 1, bool)

    monkeypatch.setattr(token_shards, "tokenizer", lambda path: Large)
    with pytest.raises(ValueError, match="16 bits"):
        token_shards.write_token_shards(edge, "any", f"file://{tmp_path}/none")
    assert not (tmp_path / "none").exists()


def test_several_shards_in_one_task(edge, monkeypatch, tmp_path):
    monkeypatch.setattr(token_shards, "MOST_TASKS", 3)
    few = edge.where("length(text) < 3000")
    path = f"file://{tmp_path}/shards"
    manifest = token_shards.write_token_shards(few, vocabulary(), path, length=64, per_shard=20).orderBy("slot").collect()
    assert len(manifest) > 60 and [r["slot"] for r in manifest] == list(range(len(manifest)))
    ids = token_shards.read_slots(path, 0, len(manifest), length=64, per_shard=20)
    assert [zlib.crc32(x.tobytes()) for x in ids] == [r["crc32"] for r in manifest]
