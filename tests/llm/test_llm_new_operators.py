"""Decontamination, Merkle manifest and alignment against plain Python, on odd rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import op11_decontaminate as D
from ledgerline.llm import op12_merkle as M
from ledgerline.llm import op13_align as X
from ledgerline.llm.tokens import PieceEncoder, WordCacheEncoder, byte_alphabet

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, hits string, tree string, block long, n string"


def table(spark, rows):
    """Documents of (doc_id, text, lang), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), "x", "x", 7, "x") for i, t, g in rows], COLUMNS)


# ------------------------------------------------------------ decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEM = "One, two; THREE four five six seven eight nine ten eleven twelve"


def plain_hits(docs, items, size=10):
    ascii_lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    found = collections.defaultdict(set)
    for name, text in items:
        w = WORD.findall(ascii_lower(text))
        for i in range(max(1, len(w) - size + 1)) if w else ():
            found[tuple(w[i:i + size])].add("" if name is None else str(name))
    out = []
    for name, text in docs:
        w, hit, ids = WORD.findall(ascii_lower(text)), set(), set()
        for n in {len(k) for k in found}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in found:
                    hit.update(range(i, i + n))
                    ids |= found[tuple(w[i:i + n])]
        out.append((name, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


DOCS = [(1, f"before {ITEM.lower()} after"), (2, "one two three four five six seven eight nine"), (3, None), (4, ""),
        (5, " .,; "), (6, f"{ITEM} {ITEM}"), (7, "Só ñandú"), (8, "só ñandú x"), (8, "só ñandú x"), (None, ITEM),
        (9, " ".join(["pad"] * 30000 + [ITEM] + ["pad"] * 10)), (10, "ÉTÉ"), (11, "one-two/three four_five SIX seven eight nine ten")]
ITEMS = [(1, ITEM), (2, "sÓ ñandú"), (2, "two three four five six seven eight nine ten eleven"), (3, None), (4, "..."),
         (10, "ÉTÉ"), (None, "pad pad pad"), (12, ITEM), (12, ITEM)]


@pytest.mark.parametrize("bound", [D.WINDOWS, 2])
def test_decontamination_equals_plain_python(spark, bound):
    docs = table(spark, [(i, t, "en") for i, t in DOCS])
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, window string")
    got = [(r.doc_id, r.n_words, sum(h.last - h.first + 1 for h in r.hits), len(r["items"]),
            hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.hits))
           for r in D.scan(docs, items, bound=bound).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(plain_hits(DOCS, ITEMS), key=key)
    if bound == D.WINDOWS:
        assert sorted(map(tuple, D.digest(docs, items).collect()), key=key) == sorted(plain_hits(DOCS, ITEMS), key=key)


def test_hits_point_into_the_original_text(spark):
    text = "Ünd — " + ITEM.upper() + "! ¿fin?"
    docs, items = table(spark, [(1, text, "en")]), spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    hit, = D.scan(docs, items).first().hits
    assert text[hit.start:hit.stop] == ITEM.upper()
    assert (hit.first, hit["last"]) == (2, 13)  # the dash is a word, as every character beyond ASCII


def test_decontamination_of_empty_tables_and_clean_rows(spark):
    docs = table(spark, [(i, t, "en") for i, t in DOCS])
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.digest(docs.limit(0), none).count() == 0
    assert not any(r.contaminated for r in D.digest(docs, none).collect())
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = D.clean(docs, items)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(
        r[0] for r in plain_hits(DOCS, [(1, ITEM)]) if not r[5])


@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), max_size=4), st.lists(st.sampled_from("abcd"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_automaton_equals_plain_python(items, text):
    names = [(i, " ".join(w)) for i, w in enumerate(items)]
    found = {}
    for i, w in names:
        w = w.split()
        for k in range(max(1, len(w) - 4)):
            found.setdefault(" ".join(w[k:k + 5]), []).append(str(i))
    first, last, met = D.Automaton(list(found.items())).scan([x.encode() for x in text])
    want = plain_hits([(0, " ".join(text))], names, 5)[0]
    assert sum(b - a + 1 for a, b in zip(first, last)) == want[2]
    assert all(b + 1 < a for b, a in zip(last, first[1:]))
    assert len({i for m in met for i in list(found.values())[m]}) == want[3]


def test_automaton_with_a_large_vocabulary():
    found = [(" ".join(f"w{i}x{j}" for j in range(10)), [str(i)]) for i in range(700)]  # 7,000 words: three places
    tree = D.Automaton(found)
    assert tree.places == 3
    text = [w.encode() for i in (5, 699, 0) for w in found[i][0].split()]
    assert tree.scan([b"z", *text, b"w5x0"]) == ([1], [30], {5, 699, 0})


# ------------------------------------------------------------ Merkle manifest

def plain_merkle(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    h = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def build(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, i):
        out = []
        for low in levels[:-1]:
            s = i - i % 8
            out.append((low[s:i], low[i + 1:s + 8]))
            i //= 8
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        leaf = h(map(field, r))
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append((r[0], leaf, h(map(field, (*r[:4], lower(r[4])))) if hit else None))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: build([r[1] for r in groups[g]]) for g in langs}
    top = build([trees[g][-1][0] for g in langs])
    out = []
    for j, g in enumerate(langs):
        for i, (name, leaf, tampered) in enumerate(groups[g]):
            way = path(trees[g], i) + path(top, j)
            node = tampered or leaf
            for left, right in way:
                node = h([*left, node, *right])
            root = top[-1][0]
            out.append((name, leaf, trees[g][-1][0], root, h(x for left, right in way for x in left + right), node, node == root))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


MANIFEST = [(None, "A", "en"), (None, None, None), (5, "Text", "en"), (5, "Text", "en"), (5, "Other", "en"), (6, None, "de"),
            (7, "", "de"), (-3, "ÄA", "ñ"), (8, "X" * 50_000, ""), (9, "lower", "z")]


def test_manifest_equals_plain_python(spark):
    rows = MANIFEST + [(100 + i, f"Doc {i}", "en") for i in range(600)] + [(1000 + i, "Same", f"g{i}") for i in range(20)]
    docs = table(spark, rows)
    want = order(plain_merkle([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]))
    got = order(map(tuple, M.digest(docs).collect()))
    assert got == want
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 8, 9, 511, 512, 513, 4097])
def test_manifest_of_one_language(spark, n):
    docs = table(spark, [(i, f"T{i}", "en") for i in range(n)])
    want = order(plain_merkle([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]))
    assert order(map(tuple, M.digest(docs).collect())) == want


def test_manifest_of_many_copies_of_a_row(spark):
    docs = table(spark, [(4, "Same", "en")]).crossJoin(spark.range(3000)).drop("id").unionByName(table(spark, [(1, "a", "en")]))
    want = order(plain_merkle([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]))
    assert order(map(tuple, M.digest(docs).collect())) == want


def test_versions_copy_only_their_ancestors(spark):
    docs = table(spark, [(i, f"T{i}", "en") for i in range(100)])
    rows = M.prove(docs).collect()
    assert M.digest(docs.limit(0)).count() == 0
    for r in rows:
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        assert (r.copies is not None) == hit and (r.folded_root != r.root) == hit
        if hit:
            assert len(r.copies) == 3 and r.copies[-1] == r.folded_root  # 100 leaves: three levels, no upper one


# ------------------------------------------------------------ alignment

ALPHABET = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "23", "'s", "!", "<s>", "<0x41>", "<|endoftext|>", "▁", "中",
            "\xa0", "ﬁ", "\x00", "The", "ñ", "́", "😀", "straße", "ción"]


@pytest.fixture(scope="module")
def tools():
    return WordCacheEncoder(A), PieceEncoder(B)


@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=20), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_cached_pieces_equal_the_libraries(tools, texts):
    texts = [None, *("".join(t) for t in texts)]
    a, b = tools
    ids = lambda x: np.array(x, "<u4").tobytes()
    assert a.encode(texts) == [ids(a.tokenizer.encode(t, add_special_tokens=False).ids) if t else b"" for t in texts]
    assert b.encode(texts) == [ids(b.model.encode(t)) if t else b"" for t in texts]


def plain_alignment(rows, tools):
    a, b = tools
    letters = byte_alphabet()
    name = {i: t for t, i in a.tokenizer.get_vocab().items()}
    piece = lambda i: bytes([int(b.model.id_to_piece(i)[1:-1], 16)]) if b.model.is_byte(i) else b.model.id_to_piece(i).replace("▁", " ").encode()
    docs, count = [], collections.Counter()
    for doc, text in rows:
        ids_a, ids_b, groups, links = [], [], [], []
        if text:
            ids_a, ids_b = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
            bytes_a, bytes_b = [bytes(letters[c] for c in name[i]) for i in ids_a], [piece(i) for i in ids_b]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ids_a, ids_b = [], []
            else:
                ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
                links = [(x, y) for x, i in zip(ids_a, ends_a) for y, j in zip(ids_b, ends_b) if i == j]
                begin = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    part = [[str(x) for x, e in zip(ids, ends) if begin < e <= end] for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
                    groups.append("|".join(map(",".join, part)))
                    begin = end
        count.update(links)
        docs.append((doc, len(ids_a), len(ids_b), groups, links))
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [(doc, na, nb, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for doc, na, nb, groups, links in docs]


def test_alignment_equals_plain_python(spark, tools):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choice(ALPHABET) for _ in range(draw.randrange(25)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "tie tie"), (72, "tie tie"), (None, "the end"), (73, " ".join(["straße"] * 400))]
    rows += [(80 + i, "an unbelievably straightforward tokenization of Donaudampfschifffahrt") for i in range(30)]
    docs = table(spark, [(i, t, "en") for i, t in rows])
    want = order(plain_alignment(rows, tools))
    assert any(r[1] == 0 and t for r, (_, t) in zip(plain_alignment(rows, tools), rows))  # some text is not spelled
    for block in (X.BLOCK_IDS, 40):
        assert order(map(tuple, X.align(docs, A, B, block).collect())) == want
    assert X.align(docs.limit(0), A, B).count() == 0


def test_pair_table_and_groups_of_a_text(spark):
    docs = table(spark, [(1, "the the cat", "en"), (2, "the", "en")])
    pairs = {(r.a, r.b): (r["count"], r.best) for r in X.pair_table(docs, A, B).collect()}
    groups = {r.doc_id: r.groups for r in X.align_rows(docs, A, B).collect()}
    the, = (x for x in groups[2].split(";"))
    assert groups[1].startswith(f"{the};{the};")
    assert pairs[tuple(map(int, the.split("|")))] == (3, True)
