"""Operator 12 against both libraries and plain loops."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from helpers import corner_rows, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from txnlake.llm import align

pytest.importorskip("tiktoken")
pytest.importorskip("sentencepiece")


def groups_of(text):
    """[(a ids, b ids)] by the libraries the files are made for."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return []
    if not hasattr(groups_of, "both"):
        plain = Tokenizer.from_file(align.FIRST)
        plain.encode_special_tokens = True
        groups_of.both = plain, sentencepiece.SentencePieceProcessor(model_file=align.SECOND)
    plain, model = groups_of.both
    alphabet = align.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in plain.id_to_token(i))) for i in plain.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode())
         for i in model.encode(text)]
    whole = (" " + text).encode()
    if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
        return []
    out, at_a, at_b, end_a, end_b = [([], [])], 0, 0, 0, 0
    while at_a < len(a) or at_b < len(b):
        if end_a <= end_b and at_a < len(a) and (end_a < end_b or not out[-1][0]):
            out[-1][0].append(a[at_a][0])
            end_a += len(a[at_a][1])
            at_a += 1
        else:
            out[-1][1].append(b[at_b][0])
            end_b += len(b[at_b][1])
            at_b += 1
        if end_a == end_b:
            out.append(([], []))
    return out[:-1]


def brute(rows):
    groups = [groups_of(r[1]) for r in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = collections.Counter(p for pairs in links for p in set(pairs))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for r, g, pairs in zip(rows, groups, links):
        listed = ";".join("|".join(",".join(map(str, side)) for side in pair) for pair in g)
        out.append((r[0], sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(pairs),
                    sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(listed.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(4)
    odd = ["<|endoftext|> <s> </s><unk>", "  two  spaces ", "▁under ▁ score", "é ﬁ Ⅷ", "\x00\x01 \x7f", "日本語のテキスト 🤖🏽 café",
           "don't we'll I'VE", "1234567 3.14", "\n\n\t x \r\n", "a", " ", "ab" * 300, "Привет мир", "l'été à l'œuvre ß"]
    alphabet = "abcdefg éè日. ,\n'12"
    rows = [(i, t) for i, t in enumerate(odd)]
    rows += [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(200)))) for i in range(60)]
    return rows + [(200 + i, prose(rng, 80, 60)) for i in range(30)] + [(200, rows[3][1])]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_matches_brute_force(spark, monkeypatch, small):
    """With small limits, every group is large, every block full and every piece a few ends."""
    if small:
        for name, value in (("LINKS", 2), ("SLICE", 100), ("BLOCK_PAIRS", 50), ("PIECE_WORK", 3)):
            monkeypatch.setattr(align, name, value)
    rows = texts() + ([] if small else corner_rows())
    got = align.alignment(documents(spark, rows, clash=not small))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_alignment_of_nothing(spark):
    assert align.alignment(documents(spark, [])).collect() == []
    assert [tuple(r) for r in align.alignment(documents(spark, [(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_first_encodes_as_the_library_does():
    from tokenizers import Tokenizer

    own, plain = align.First(align.FIRST), Tokenizer.from_file(align.FIRST)
    plain.encode_special_tokens = True
    for _, t in texts():
        assert own.encode(" " + t).tolist() == plain.encode(" " + t, add_special_tokens=False).ids


ends = st.lists(st.integers(1, 60), min_size=1, max_size=40, unique=True).map(sorted)


@settings(max_examples=300, deadline=None)
@given(ends, ends, st.integers(1, 9))
def test_common_ends_of_any_pieces(a, b, work):
    top = max(a[-1], b[-1]) + 1  # both sides end at the end of the text
    a, b = np.array([*a, top]), np.array([*b, top])
    in_a, in_b = align.common_ends(a, b, work)
    both = sorted(set(a.tolist()) & set(b.tolist()))
    assert a[in_a - 1].tolist() == both and b[in_b - 1].tolist() == both


@given(ends, ends)
def test_merge_path_divides_the_merge(a, b):
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    got = align.merge_path(np.array(a), np.array(b), np.arange(len(merged) + 1))
    assert got.tolist() == [sum(1 for _, side in merged[:d] if side == 0) for d in range(len(merged) + 1)]


def _row_groups(df):
    import pyarrow.parquet as pq

    return [g for f in df.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata]
            for g in [m.row_group(i).num_rows for i in range(m.num_row_groups)]]


def test_a_task_never_holds_many_blocks(spark, monkeypatch):
    """A task with many blocks writes, reads and answers them one at a time."""
    monkeypatch.setattr(align, "SLICE", 300)
    monkeypatch.setattr(align, "BLOCK_PAIRS", 50)
    rows = texts()
    docs = documents(spark, rows).coalesce(1)
    blocks = align.token_blocks(docs)
    assert blocks.count() > 20 and set(_row_groups(blocks)) == {1}
    got = align.alignment(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan  # a block's answers are sorted, not one object of the JVM
    assert got.rdd.getNumPartitions() >= blocks.count()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


@given(st.lists(st.integers(0, 2**40), max_size=20))
def test_narrow_numbers_come_back(numbers):
    numbers = np.array(numbers, np.int64)
    assert align._wide(align._narrow(numbers), len(numbers)).tolist() == numbers.tolist()
