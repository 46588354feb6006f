"""Cross-tokenizer alignment against a plain version."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from pitchlake.llm import alignment
from test_llm_brute_force import clashing, prose, small_docs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts():
    rng = random.Random(2)
    return ["<|endoftext|> and <s> </s> <0x41>", " leading and  double   spaces ", "a▁b", "日本語のテキスト🙂🙂", "\r\n\t x y",
            "ﬁ Å é é", "\x00\x01", "aaaa" * 50, " ", "\n" * 30, "ａｂｃ½", prose(rng, 4000),
            "".join(chr(rng.choice((32, 65, 97, 233, 0x4e00, 0x1F600, 10, 0x2581, 0x301))) for _ in range(400))]


def plain(rows):
    """groups, links and counts with sets and loops; entry bytes by the library's own decoder."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs, holders = [], defaultdict(int)
    alphabet = {c for c in ByteLevel.alphabet()}
    back = {}
    for x in range(256):  # the byte-level form of every byte, from the pre-tokenizer itself
        if x < 128:
            back[ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(x))[0][0]] = x
    for x in range(0x80, 0x800):
        s = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(x))[0][0]
        back |= dict(zip(s, chr(x).encode()))
    for x in (0x800, 0x1000, 0x2000, 0x3000, 0x4000, 0x5000, 0x6000, 0x7000, 0x8000, 0x9000, 0xa000, 0xb000, 0xc000, 0xd000,
              0xe000, 0xf000, 0x10000, 0x40000, 0x80000, 0xc0000, 0x100000):
        s = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(x))[0][0]
        back |= dict(zip(s, chr(x).encode()))
    assert set(back) <= alphabet
    for doc, text in rows:
        ia = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        ba = [bytes(back[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        groups = []
        if text and b"".join(ba) == raw and b"".join(bb) == raw:
            ends_a, ends_b = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
            last = 0
            for e in sorted(set(ends_a) & set(ends_b)):
                groups.append(([i for i, x in zip(ia, ends_a) if last < x <= e], [i for i, x in zip(ib, ends_b) if last < x <= e]))
                last = e
        links = [(x, y) for g, h in groups for x in g for y in h]
        for p in set(links):
            holders[p] += 1
        docs.append((doc, groups, links))
    top = defaultdict(int)
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    out = []
    for doc, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
                    sum(holders[p] == top[p[0]] for p in links), sum(holders[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("pairs", [alignment.PAIRS, 50])
def test_report(spark, pairs):
    rows = [(d, t) for d, t, *_ in small_docs()] + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    rows += [rows[2], rows[2], (None, "no id"), (2, "one id, two texts")]
    docs = spark.createDataFrame([(d, t, "en", None, 0) for d, t in rows], DOCS).repartition(3)
    got = alignment.report(clashing(docs), pairs=pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_no_documents_and_no_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.report(docs).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert alignment.report(docs.limit(0)).count() == 0


def test_texts_in_pieces_encode_like_the_whole(monkeypatch):
    a, b = (public_tokenizers.path(x) for x in (alignment.MODEL_A, alignment.MODEL_B))
    cut, whole = alignment.Tokenizers(a, b), alignment.Tokenizers(a, b)
    assert cut.cuttable
    whole.cuttable = False
    rng = random.Random(6)
    texts = [x for x in [r[1] for r in small_docs()] + odd_texts() if x]
    texts += ["".join(rng.choice("ab 'st.\n\t  \u00a0\u2003\x1c1é日▁") for _ in range(60)) for _ in range(400)]
    want = [x.tolist() for x in whole.encode(texts)]
    monkeypatch.setattr(alignment, "KNOWN", 500)
    for part in (texts, texts[:7], texts):
        got = [x.tolist() for x in cut.encode(part)]
        assert got == (want if part is texts else [x.tolist() for x in whole.encode(part)])
    assert len(cut.pieces(texts[0])) > 5


def test_links_in_blocks_and_wide_groups(monkeypatch):
    rng = np.random.default_rng(4)
    size_a, size_b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    after_a, after_b = np.cumsum(size_a), np.cumsum(size_b)
    ids_a, ids_b = rng.integers(0, 5, after_a[-1]), rng.integers(0, 5, after_b[-1])
    doc = np.sort(rng.integers(0, 6, 60))
    want = defaultdict(int)
    for g in range(60):
        for x in ids_a[after_a[g] - size_a[g]:after_a[g]]:
            for y in ids_b[after_b[g] - size_b[g]:after_b[g]]:
                want[int(doc[g]), int(x * 100 + y)] += 1
    for bound in (1, 10, 40, 1 << 20):
        monkeypatch.setattr(alignment, "LINKS", bound)
        d, p, n = alignment.linked_pairs(ids_a, ids_b, after_a, after_b, doc, 100)
        assert list(zip(d.tolist(), p.tolist())) == sorted(want)
        assert {(i, j): k for i, j, k in zip(d.tolist(), p.tolist(), n.tolist())} == want


def test_gallop_is_a_lower_bound():
    rng = np.random.default_rng(7)
    ends = np.sort(rng.choice(5000, 700, replace=False))
    for low, high in ((0, 700), (100, 101), (350, 700)):
        wanted = rng.integers(0, 5200, 400)
        guess = rng.integers(low, high, 400)
        got = alignment.gallop(wanted, ends, np.full(400, low), np.full(400, high), guess)
        assert (got == low + np.searchsorted(ends[low:high], wanted)).all()


def test_pieces_joined_for_a_are_encoded_as_alone(monkeypatch):
    paths = [public_tokenizers.path(m) for m in (alignment.MODEL_A, alignment.MODEL_B)]
    monkeypatch.setattr(alignment, "JOINED", 5)
    together, alone = alignment.Tokenizers(*paths), alignment.Tokenizers(*paths)
    assert together.cuttable
    calls, plain_call = [], together.encode_a
    monkeypatch.setattr(together, "encode_a", lambda texts: (calls.append(len(texts)), plain_call(texts))[1])
    monkeypatch.setattr(alone, "joined_a", lambda *_: None)
    rng = random.Random(8)
    texts = odd_texts() + ["a \n", "b\u00a0", "", "tail  ", "\u3000 c"] + [prose(rng, 300) for _ in range(5)]
    got, want = together.encode(texts), alone.encode(texts)
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, want))
    assert len(calls) == 1 and calls[0] < 0.6 * len(together.known)
    # bytes that do not add up: each piece is looked at by itself
    for t in (together, alone):
        t.forget()
        monkeypatch.setattr(t, "length_a", t.length_a + (np.arange(t.n_a) == got[0][0]))
    got, want = together.encode(texts), alone.encode(texts)
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, want))
