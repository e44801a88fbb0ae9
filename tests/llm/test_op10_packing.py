import zlib
from collections import defaultdict

import numpy as np

from guildbook.llm import op10_packing as op


def check_packing(docs, rows, path, slack=1.02):
    """Every document's pieces are right, sequences are gapless, and there are few of them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = defaultdict(list)
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i].append((k, at, len(part), zlib.crc32(part.tobytes())))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
        total += at
    assert len(bins) <= slack * -(-total // 2048) + 2


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_packing(docs, op.op10_packing(spark, sf).collect(), op.default_path())


def test_defined_cases(spark):
    docs = [(1, None), (2, ""), (3, "It's NFC é, é and ΑΣ ΟΔΟΣ <|endoftext|> x\x1cy"), (4, "word " * 9000), (5, "a b"), (5, "a b"), (None, "ſ ² ½ x" * 400)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, piece int, group string")
    check_packing(docs, op.pack_documents(df, op.default_path()).collect(), op.default_path(), slack=2)
    assert op.pack_documents(spark.createDataFrame([], "doc_id long, text string"), op.default_path()).count() == 0


def test_words_are_cut_as_the_tokenizer_does():
    tool = op.Pieces(op.default_path())
    for t in ["ΣΑΣ", "İstanbul ǅ", "<|startoftext|>x", "a\x1cb\u0085c d e", "don't I'LL 'RE", "é é", "x" * 300, "½²³ªº µ×÷", "1234567890 $$$%%%", "'street we'll 'LL --'s ''s x's'S 'd é's ß-\x0b'm", "'", "a'", "'re", "l l'", "\x00 é", "Ⱥbc 'Tis", "x\u0000", ""]:
        assert np.frombuffer(tool.encode([t])[0], "<u4").tolist() == [*tool.tokenizer.encode(t, add_special_tokens=False).ids, 0], t


def test_swaps_empty_a_bin():
    """Best fit leaves three bins where two will do; an exchange of one for one and a move empty the third."""
    bins = op.Bins([6, 5, 5, 4], 10)
    for items in ([0], [1, 3], [2]):
        bins.items.append([])
        bins.fill.append(0)
        for i in items:
            bins.items[-1].append(i)
            bins.fill[-1] += bins.lengths[i]
    bins.improve()
    assert sorted(sum(bins.lengths[i] for i in b) for b in bins.items) == [0, 10, 10]
    rng = np.random.default_rng(4)
    lengths = rng.integers(400, 1200, 900)
    number, offset = op.pack(lengths)
    plain = op.Bins(lengths.tolist(), 2048)
    for i in np.argsort(-lengths, kind="stable"):
        plain.best_fit(int(i))
    assert number.max() + 1 <= len(plain.items)
    fill = np.bincount(number, lengths)
    assert fill.max() <= 2048 and fill.sum() == lengths.sum()


def test_ids_beyond_floats_beside_a_null(spark):
    rows = [(2**60 + 1, "one text"), (2**60 + 2, "another text"), (None, "a third")]
    got = op.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), op.default_path()).collect()
    assert {r["doc_id"] for r in got} == {2**60 + 1, 2**60 + 2, None}
