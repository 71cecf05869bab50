import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import packing
from strata.llm._util import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "\n\n a", "a\t b  c", "x  y", "a\x1c b", "it's  'll we've",
         "<|endoftext|> x <|endoftext|>", "é中\U0001F600 ñ", "12 3.4 5-6 !! ?", "a" * 500, "\u0085 a", "tab\there now", "end.\n"]


def test_pieces_of_a_text_give_the_ids_of_the_whole_text(plain):
    rnd = random.Random(1)
    bits = ["a", "Word", " ", " ", "  ", "\n", "\t", ".", "'s", "é", "12", " ", "\x1d", "!!", "<|endoftext|>", "　"]
    texts = TEXTS + ["".join(rnd.choices(bits, k=rnd.randint(0, 25))) for _ in range(3000)]
    encoder = packing.Encoder(PATH)
    for _ in range(2):  # the second time from what is kept
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        for text, ids in zip(texts, got):
            assert ids == plain(text), repr(text)


def test_the_query_gives_the_ids_of_tokenizers_as_it_is(spark, tmp_path):
    """Special tokens in a text, too: against a tokenizer without any setting."""
    from tokenizers import Tokenizer

    import corpus_pipeline
    from strata.llm import queries
    unset = Tokenizer.from_file(PATH)
    rnd = random.Random(6)
    bits = ["a", "Word", " ", " ", "  ", "\n", "\t", ".", "'s", "é", "<|endoftext|>", "<|endoftext", "|>"]
    texts = ["end <|endoftext|> next", *TEXTS, *("".join(rnd.choices(bits, k=rnd.randint(0, 25))) for _ in range(500))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    def ids(text):
        return unset.encode(text, add_special_tokens=False).ids
    assert ids(texts[0]) == [437, 220, 50256, 1306]
    for rows in (queries.QUERIES["op9_hierarchical_packing"](spark, str(tmp_path)).collect(),
                 corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()):
        check(rows, dict(enumerate(texts)), ids)


def sequences(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    return by


def check(rows, docs, plain):
    """Every id in one piece, sequences gapless and a power of two long."""
    for pieces in sequences(rows).values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        length = sum(p.length for p in pieces)
        assert length <= 1024 and length & (length - 1) == 0 and {p.sequence_length for p in pieces} == {length}
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(docs)
    for doc_id, text in docs.items():
        ids = np.array(plain(text or "") + [0], "<u4")
        pieces = sorted(by[doc_id], key=lambda r: r.start)
        assert {p.doc_tokens for p in pieces} == {len(ids)}
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())


def test_documents_are_packed_whole(documents, plain):
    rnd = random.Random(3)
    docs = {i: t for i, t in enumerate(TEXTS)}
    docs |= {100 + i: " ".join(rnd.choice(["the", "of", "stone", "zebra,"]) for _ in range(int(rnd.expovariate(1 / 300))))
             for i in range(150)}
    docs |= {900: None, 901: "long " * 30_000}
    rows = packing.pack_documents(documents(list(docs.items())).repartition(3), PATH).collect()
    check(rows, docs, plain)
    steps = defaultdict(list)
    for r in rows:
        steps[r.step_group].append(r)
    for members in steps.values():
        assert len({m.sequence_length for m in members}) == 1
        assert sum(m.length for m in members) <= packing.STEP_TOKENS
    whole = sum(r.length == r.doc_tokens for r in rows if r.doc_tokens <= 1024)
    assert whole > 0.6 * sum(r.start == 0 for r in rows if r.doc_tokens <= 1024)


def test_repeated_rows_null_ids_and_empty_tables(documents):
    rows = packing.pack_documents(documents([(1, "a b"), (1, "a b"), (None, "c")]), PATH).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 6 and sum(r.length for r in rows if r.doc_id is None) == 2
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_small_pools_lose_nothing(documents, plain, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 600)
    rnd = random.Random(4)
    docs = {i: " ".join(["tok"] * rnd.randint(0, 700)) for i in range(300)}
    check(packing.pack_documents(documents(list(docs.items())).coalesce(1), PATH).collect(), docs, plain)


def test_open_windows_end_at_powers_of_two():
    pieces = [packing.Piece(i, 0, bytes(4 * n)) for i, n in enumerate([3, 700, 42])]
    lengths = [sum(p.length for p in w) for w in packing.at_powers(pieces)]
    assert lengths == [512, 128, 64, 32, 8, 1]


def test_step_groups_are_balanced():
    rnd = random.Random(5)
    windows = []
    for _ in range(64):
        cuts = sorted(rnd.sample(range(1, 1024), rnd.randint(0, 6)))
        ends = [0, *cuts, 1024]
        windows.append([packing.Piece(0, 0, bytes(4 * (b - a))) for a, b in zip(ends, ends[1:])])
    groups, nxt = packing.step_groups(windows, 16 * 1024, 7)
    assert set(groups) == {7, 8, 9, 10} and nxt == 11 and all(groups.count(g) == 16 for g in set(groups))
    cost = [sum(sum(p.length ** 2 for p in w) for w, g in zip(windows, groups) if g == k) for k in range(7, 11)]
    assert max(cost) < 1.05 * min(cost)


def test_a_worker_keeps_its_encoder_and_old_pieces(monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    encoder = packing.encoder_of_worker(path, True)
    assert packing.encoder_of_worker(path, True) is encoder and packing.encoder_of_worker(path, False) is not encoder
    monkeypatch.setattr(packing, "PRETOKENS", 8)
    texts = [" ".join(f"word{i % 7} other{i} w" for i in range(j, j + 5)) for j in range(40)]
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path)
    small = packing.Encoder(path, True)
    for text in texts + texts[::-1]:
        assert small.encode([text]) == [np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
        assert len(small._old) + len(small._kept) <= 8 + 20


def test_the_pipeline_keeps_fewer_pieces_and_gives_the_same_ids(spark, monkeypatch):
    import corpus_pipeline
    path = tokenizer_path("byte_bpe_50k.json")
    small, whole = packing.Encoder(path, True, 8), packing.Encoder(path, True)
    texts = [" ".join(f"word{i % 7} other{i} w" for i in range(j, j + 5)) for j in range(40)]
    for text in texts + texts[::-1]:
        assert small.encode([text]) == whole.encode([text])
        assert len(small._old) + len(small._kept) <= 8 + 20 < packing.PRETOKENS
    asked = []
    monkeypatch.setattr(packing, "_packed", lambda *args: asked.append(args[-1]) or (lambda batches: batches))
    corpus_pipeline.pack(spark, spark.createDataFrame([], "doc_id long, text string"), "")
    assert asked == [corpus_pipeline.KEPT_PIECES] and asked[0] <= packing.PRETOKENS // 4
