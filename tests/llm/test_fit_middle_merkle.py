"""Best-fit packing, fill-in-the-middle forms and Merkle manifests against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tablewright.llm import best_fit, fill_middle, merkle

#: Extra columns clash with names the operators use inside and in their results.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, rank long, n int, form string, "
          "_text string, digest string, tree string, block int, output string")


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "Über", "stone,", "là", "x9", "日本", "(blue)", "don't", "Zed"]) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", "", "a", "A b", "a<P>b", "tab\tand\r\nline", "日本 語😀z", "x" * 9000, prose(1, 3000), "<", "S><P",
             "<|endoftext|> b", " " * 300, prose(2, 50), prose(2, 50), "$1 \\2 {3}", "ends with <", "<S text P> M>"]
    extra = (7, 1, "f", "t", "d", "u", 2, "o")
    out = [(i, t, "en" if i % 2 else None, ["s0", None, "s1", "ü"][i % 4] if i % 3 else "s0", None if i % 5 == 0 else i, *extra)
           for i, t in enumerate(texts)]
    out += [(3, "a", None, "s0", 1, *extra), (3, "a", None, "s0", 1, *extra), (None, "Null Key", None, "s1", 0, *extra),
            (None, None, None, None, None, *extra)]
    out += [(100 + i, prose(i, 3 + i % 40), "fr", "hot", i, *extra) for i in range(300)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def middle(doc, text):
    """Tokens, form and the three parts, by the definition."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    h = [int(sha(f"1:{'' if doc is None else doc}")[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    return len(units), "plain" if plain else "spm" if h[3] % 100 < 20 else "psm", [
        "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]


def test_fill_in_middle(docs, empty, rows):
    want = []
    for doc, text, *_ in rows:
        n, form, (pre, mid, suf) = middle(doc, text)
        out = {"plain": text or "", "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]
        sizes = (None, None) if form == "plain" else (len(pre), len(mid))
        want.append((doc, text or "", n, form, *sizes, out))
    made = fill_middle.fill_in_middle(docs)
    assert made.columns == [*docs.columns, "_n", "_form", "_output", "prefix_chars", "middle_chars"]
    got = made.select("doc_id", fill_middle.restored(F.col("_output"), F.col("_form")), "_n", "_form", "prefix_chars",
                      "middle_chars", "_output").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {w[3] for w in want} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(empty).count() == 0


def test_tokens_across_stretches(spark):
    texts = ["", "a", "ab", "abcdefgh", "ab cdéfg hi", "é😀é", " a b ", "aaaaaaa bbbbbbb", "1234567"]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    for stretch in (1, 2, 3, 7, 100):
        got = table.select("text", fill_middle.token_count(F.col("text"), stretch).alias("n")).collect()
        assert {r.text: r.n for r in got} == {t: len(re.findall("[A-Za-z]+|[^A-Za-z]", t)) for t in texts}


def test_fill_in_middle_of_very_long_texts(spark):
    lines = ["a" * 10_000_000, "1" * 3_000_000, "ab " * 2_000_000, "é\n" * 1_000_000]
    table = spark.createDataFrame([(i, lines[i % 4]) for i in range(8)], "doc_id long, text string").repartition(8)
    made = fill_middle.fill_in_middle(table, stretch=1 << 18)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    got = {r.doc_id: r for r in made.select("doc_id", "n", "form", (back == F.col("text")).alias("same"),
                                            F.sha2(F.col("output").cast("binary"), 256).alias("digest")).collect()}
    assert [got[i].n for i in range(4)] == [1, 3_000_000, 4_000_000, 2_000_000] and all(r.same for r in got.values())
    for i in range(8):
        _, form, (pre, mid, suf) = middle(i, lines[i % 4])
        out = {"plain": lines[i % 4], "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]
        assert (got[i].form, got[i].digest) == (form, sha(out))


def plain_best_fit(sizes, length):
    """Best-fit decreasing, one by one: the tokens in each sequence. Which of two equal gaps is taken is
    open, so the sequences' contents are not compared."""
    bins = []
    for size in sorted(sizes, reverse=True):
        fits = [b for b in bins if sum(b) + size <= length]
        if fits:
            max(fits, key=sum).append(size)
        else:
            bins.append([size])
    return sorted(map(sum, bins))


def test_supersteps_equal_best_fit_decreasing():
    rng = random.Random(4)
    for length, n, top in ((16, 200, 16), (64, 300, 64), (64, 400, 20), (2048, 300, 2048), (7, 50, 3), (5, 0, 5)):
        sizes = [min(rng.randint(1, top), rng.randint(1, top)) for _ in range(n)]
        counts = {s: sizes.count(s) for s in set(sizes)}
        matches, sequences = best_fit.supersteps(counts, length)
        bins = [[] for _ in range(sequences)]
        for s, count in counts.items():
            own = sorted((m for m in matches if m.size == s), key=lambda m: m.first)
            assert own[0].first == 0
            for m, end in zip(own, [*(x.first for x in own[1:]), count]):
                for i in range(end - m.first):
                    bins[m.sequence + i // m.each].append((m.fill + i % m.each * s, s))
        assert all(sum(x[1] for x in b) <= length for b in bins)
        for b in bins:  # gapless
            b.sort()
            assert [x[0] for x in b] == [0, *np.cumsum([x[1] for x in b])[:-1]]
        want = plain_best_fit(sizes, length)
        assert sequences == len(want)
        assert sorted(sum(x[1] for x in b) for b in bins) == want


def test_runs_stay_few_at_any_size():
    counts = {s: 10 ** 12 + s * 7919 % 10 ** 9 for s in range(1, 2049)}
    matches, sequences = best_fit.supersteps(counts)
    assert len(matches) < 40_000
    assert sequences <= 1.001 * sum(s * n for s, n in counts.items()) / 2048


def test_best_fit_packing(docs, empty, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made = best_fit.pack(docs, length=64)
    assert made.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = made.toPandas()
    want, sizes = [], []
    for doc, text, *_ in rows:
        ids = np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        want += [(-1 if doc is None else doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                 for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        sizes += [b - a for a, b in zip(cuts, cuts[1:])]
    pieces = got[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(-1).astype(int)
    assert sorted(pieces.itertuples(index=False, name=None)) == sorted(want)
    ordered = got.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all() and ends.max() <= 64
    assert sorted(got.groupby("sequence_id").length.sum()) == plain_best_fit(sizes, 64)
    assert best_fit.pack(empty).count() == 0


def test_ids_of_both_ways_agree():
    path, ranks = (public_tokenizers.path(f"byte_bpe_50k.{e}") for e in ("json", "tiktoken"))
    slow, fast = best_fit.ByteIds(path), best_fit.ByteIds(path, ranks)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(1)
    texts = ["".join(f"a{chr(c)}1 {chr(c)}b.{chr(c)} {chr(c)}\n" for c in points[i:i + 64]) for i in range(0, len(points), 640)]
    texts += ["".join(chr(rng.choice(points)) for _ in range(200)) for _ in range(500)]
    texts += [" " * 100_000, "\n" * 50_000 + "a", "x" * 100_000, "a <|endoftext|> b", "it's we'll 'S", prose(3, 500), "", "  　 x"]
    assert all((slow.of(t) == fast.of(t)).all() for t in texts)


def joined(parts):
    return sha("".join(parts))


def plain_tree(leaves, fan):
    """The root, and the digests beside the own node per level, for every leaf."""
    nodes, at, sides = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for leaf, i in enumerate(at):
            run = runs[i // fan]
            sides[leaf].append(("".join(run[:i % fan]), "".join(run[i % fan + 1:])))
        nodes, at = [joined(r) for r in runs], [i // fan for i in at]
    return nodes[0], sides


def plain_manifest(rows, fan, tampered):
    def leaf(r, text):
        return joined("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text))

    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])], fan) for s in names}
    root, above = plain_tree([trees[s][0] for s in names], fan)
    out = []
    for s, up in zip(names, above):
        for (_, _, own, r), sides in zip(sorted(sources[s], key=lambda x: x[:3]), trees[s][1]):
            path = [*sides, *up]
            d = leaf(r, r[1].translate(lower)) if tampered(r[0]) and r[1] is not None else own
            for left, right in path:
                d = joined((left, d, right))
            out.append((r[0], own, trees[s][0], root, joined(a + b for a, b in path), d, d == root))
    return out


def every_fifth(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


@pytest.mark.parametrize("fan,height", [(16, 3), (2, 1), (3, 2), (16, 1)])
def test_merkle_manifest(docs, rows, fan, height):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.manifest(docs, tampered=tampered, with_path=True, fan=fan, height=height).collect()
    want = plain_manifest(rows, fan, every_fifth)
    assert sorted(repr(tuple(r)[:7]) for r in got) == sorted(map(repr, want))
    assert len({r.verified for r in got}) == 2
    for r in got:
        assert merkle.fold(r.leaf, [(p.left, p.right) for p in r.path]) == r.root


def test_merkle_of_small_tables(docs, empty, spark):
    assert merkle.manifest(empty).count() == 0
    one = merkle.manifest(docs.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root
    assert one[0].proof_sha256 == sha("") and one[0].verified
    many = spark.range(40).selectExpr("id AS doc_id", "'t' AS text", "'l' AS lang", "'s' || id AS source", "1L AS n_chars")
    got = merkle.manifest(many, fan=2, height=2).collect()  # a tree of sources deeper than one block
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in many.collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_manifest(rows, 2, lambda d: False)))


def test_merkle_appends_equal_the_whole_tree():
    for fan in (2, 3, 16):
        for n in (1, 2, fan - 1 or 1, fan, fan + 1, fan * fan, fan * fan + 1, 300):
            leaves = [sha(str(i)) for i in range(n)]
            tree = merkle.OpenTree(fan)
            places = [tree.append(d) for d in leaves]
            assert (tree.root(), [merkle.witness(p) for p in places]) == plain_tree(leaves, fan)
