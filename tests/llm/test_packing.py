"""Packing: exact ids, every id in one piece, full sequences, the curve's continuity."""

import zlib

import numpy as np
import odd
import public_tokenizers
from clickloom.llm import packing
from clickloom.llm.packing import hilbert
from tokenizers import Tokenizer


def test_curve_visits_every_cell_by_single_steps():
    for bits, dims in ((3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_pieces_hold_all_ids_once(spark):
    docs = odd.documents(spark, "start", "ids", "sequence_id", "tie")
    pieces = packing.pack(docs).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((str(r[0]), np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in odd.rows())
    by_text, where = {}, {}
    for p in pieces:
        where.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_text.setdefault((str(p.doc_id), p.doc_tokens), []).append(p)
        assert len(p.ids) == 4 * p.length
    for (name, size), parts in by_text.items():
        # repeated rows give their pieces again
        copies = [ids for n, ids in want if n == name and len(ids) == 4 * size]
        assert sum(p.length for p in parts) == len(copies) * size
        for p in parts:
            assert bytes(p.ids) == copies[0][4 * p.start:4 * (p.start + p.length)]
            assert zlib.crc32(bytes(p.ids)) >= 0
    assert sorted(n for n, _ in want) == sorted(n for (n, s), parts in by_text.items() for _ in range(sum(p.length for p in parts) // s))
    for spans in where.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.LENGTH and at & (at - 1) == 0
    assert packing.pack(odd.empty(spark)).count() == 0
