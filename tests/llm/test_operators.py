"""The training-data operators against brute force, on small tables with the awkward cases."""

import hashlib
import itertools
import math
import random
import textwrap
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import (exact_dedup, licenses, mixing, near_dedup, packing, secrets, token_counts, toxicity,
                             vector_search, web_archive)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, slot long, _text string"


def prose(seed, words):
    rng = random.Random(seed)
    pool = ["alpha", "river", "stone", "Über", "garden", "token", "là", "summer", "window", "seven", "blue", "paper"]
    return " ".join(rng.choice(pool) + str(rng.randrange(40)) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    long = prose(1, 6000)
    near = prose(2, 120)
    texts = [None, "", "", "A b", "a B", "Ä b", "ä b", long, long.upper(), near, near + " tail", near.replace("river", "lake", 1),
             "one two three", "x" * 9000, "tab\tand\r\nline", "日本 語", "İstanbul Σας <|endoftext|> x", prose(3, 80), prose(3, 80)]
    rows = [(i, t, "en" if i % 2 else None, ["s0", "s0", "s1", None][i % 4], 0, "r", 1, "u") for i, t in enumerate(texts)]
    rows += [(3, "A b", "en", "s0", 0, "r", 1, "u"), (None, "null key", None, "s1", 0, "r", 1, "u")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(docs, empty):
    rows = docs.select("doc_id", "text").collect()
    sizes, keeps = {}, {}
    for r in rows:
        t = lowered(r.text)
        sizes[t] = sizes.get(t, 0) + 1
        keeps[t] = max(keeps.get(t, -1), -1 if r.doc_id is None else r.doc_id)
    got = exact_dedup.equal_groups(docs).collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, keeps[lowered(r.text)], sizes[lowered(r.text)],
                   hashlib.sha256(lowered(r.text).encode()).hexdigest()) for r in rows)
    assert sorted((g.doc_id is None, g.doc_id or 0, -1 if g.keep_id is None else g.keep_id, g.group_size, g.text_sha256)
                  for g in got) == want
    assert sum(g.kept for g in got) == len(sizes)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(sizes)
    assert exact_dedup.equal_groups(empty).count() == exact_dedup.drop_copies(empty).count() == 0


def test_chunks_make_up_the_text(docs, spark):
    made = docs.select("text", exact_dedup.chunks_of(F.coalesce("text", F.lit(""))).alias("c")).collect()
    assert all("".join(r.c) == (r.text or "") for r in made)
    store = exact_dedup.chunk_store(docs).collect()
    assert all(r.verified for r in store)
    # a passage behind other text is cut alike once a content-defined cut has been met
    rng = random.Random(5)
    text = " ".join(rng.choice(["bread", "among", "of", "stamp", "idea", "song", "apple", "team", "second", "the", "old"]) for _ in range(3000))
    both = spark.createDataFrame([(text,), ("other start " + text,)], "text string")
    a, b = (set(r.c) for r in both.select(exact_dedup.chunks_of(F.col("text")).alias("c")).collect())
    assert len(a & b) >= len(a) / 2


def brute_classes(texts, similarity=0.8):
    shingles = near_dedup.Shingles()
    sets = [set(shingles.set_of(t or "").tolist()) for t in texts]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and both >= similarity * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def test_near_classes(docs, empty, spark):
    base = prose(9, 150).split()
    many = [(100 + i, " ".join(base[:i] + ["w%d" % i] + base[i + 1:]), None, None, 0, "", 0, "") for i in range(0, 60)]
    table = docs.union(spark.createDataFrame(many, SCHEMA))
    rows = table.select("doc_id", "text").collect()
    want = brute_classes([r.text for r in rows])
    got = near_dedup.near_classes(table).select("doc_id", "class_id", "class_size", "kept").collect()
    groups = {}
    for r, c in zip(rows, want, strict=True):
        groups.setdefault(c, []).append(r.doc_id)
    sizes = sorted(len(g) for g in groups.values())
    assert sorted(r.class_size for r in got if r.kept) == sizes
    heads = {d: min(g, key=lambda x: (x is not None, x)) for g in groups.values() for d in g if g.count(d) == 1}
    assert all(r.class_id == heads[r.doc_id] for r in got if r.doc_id in heads and r.doc_id is not None)
    kept = near_dedup.drop_near_copies(table)
    assert kept.columns == table.columns and kept.count() == len(sizes)
    assert near_dedup.near_classes(empty).count() == 0


def test_large_group_links_through_heads(spark):
    base = prose(4, 300).split()
    rows = [(i, " ".join(base[:i % 290] + [f"v{i}"] + base[i % 290 + 1:])) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_dedup.near_classes(table).select("class_id").distinct().count() == 1


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2 ** 63, 400).astype(np.uint64), rng.integers(0, 2 ** 63, 100).astype(np.uint64)
    parts = [a, np.concatenate([a[:300], b])]
    made = near_dedup.signatures(np.concatenate(parts), np.repeat([0, 1], [400, 400]), 2, 2000)
    assert abs((made[0] == made[1]).mean() - 300 / 500) < 0.05
    assert np.isfinite(made).all()


def test_pfair_pattern_stays_within_a_block():
    for shares in ({"a": 1, "b": 1}, {"a": 700, "b": 200, "c": 100, "d": 24}, {str(i): 7 + i for i in range(25)}):
        frame = sum(shares.values())
        pattern = mixing.frame_pattern(shares, frame)
        assert sorted(itertools.chain(*pattern.values())) == list(range(frame))
        for s, slots in pattern.items():
            for j, at in enumerate(slots):
                assert j * frame // shares[s] <= at < -(-(j + 1) * frame // shares[s])
            got = np.cumsum(np.isin(np.arange(frame), slots))
            assert np.abs(got - np.arange(1, frame + 1) * shares[s] / frame).max() < 1


def test_pfair_keeps_to_uneven_weights_over_many_frames(spark):
    weights = {f"s{i:02}": (i + 1) ** 0.7 / 3 for i in range(20)} | {"rare": 1e-4}
    total = sum(weights.values())
    phases = mixing.phases_of(dict.fromkeys(weights, 1200), weights, frame=64)
    phase, most = phases[0], phases[1].first
    assert most > 10_000 and len(phases) <= len(weights)
    got, slot = dict.fromkeys(weights, 0), 0
    for nth in range(-(-most // 64)):
        for s, j in phase.slots_of(nth):
            assert j == got[s]
            got[s] += 1
            slot += 1
            if slot % 7 == 0:
                assert all(abs(n - weights[x] / total * slot) < 1 + 1e-6 for x, n in got.items())
    rows = [(i, "x" * 8, f"s{i % 3}") for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    uneven = {"s0": 0.61, "s1": 0.29, "s2": 0.1}
    plan = mixing.pfair_schedule(table, uneven, block_chars=8, frame=16).toPandas().sort_values("slot")
    assert plan.slot.tolist() == list(range(6000))
    first = plan.head(3000)
    assert ((first.release <= first.slot) & (first.slot < first.deadline)).all()
    names = first.row.map(lambda r: r["source"])
    for s, w in uneven.items():
        assert np.abs((names == s).cumsum() - w * np.arange(1, 3001)).max() < 1 + 1e-6


def test_mixing_keeps_every_row(docs, empty):
    plan = mixing.pfair_schedule(docs, {"s0": 3.0, "s1": 1.0}, block_chars=64, frame=16)
    assert plan.count() == docs.count()
    assert plan.groupBy("row.source", "block").agg(F.countDistinct("slot").alias("n")).where("n > 1").isEmpty()
    assert plan.groupBy("slot").agg(F.countDistinct("row.source", "block").alias("n")).where("n > 1").isEmpty()
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == docs.count() and mixing.mixed(empty).count() == 0


def test_packing_against_the_tokenizer(docs, empty, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    table = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    pieces = packing.pack(table, length=64, window_sequences=2).toPandas()
    for r in table.collect():
        ids = np.asarray(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        own = pieces[pieces.doc_id == r.doc_id].sort_values("start")
        assert own.length.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1]]
        for p in own.itertuples():
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    ordered = pieces.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all()
    sizes = ordered.groupby("sequence_id").length.sum()
    assert sizes.index.tolist() == list(range(len(sizes)))
    assert all(n & (n - 1) == 0 for n in sizes) and (sizes[:-8] == 64).all()
    assert packing.pack(empty).count() == 0


def test_packing_short_way_equals_the_tokenizer():
    ids = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert ids.direct
    chars = [c for c in map(chr, range(0x10FFFF)) if not 0xD800 <= ord(c) < 0xE000 and packing.PLAIN.fullmatch(c)]
    texts = [*chars, *(a + b for a in [*chars, "¹"] for b in [*chars, "¹"]), "end.¹", "¹¹", "word¹ 2¹"]
    texts += [f"{a}{c}{b}" for c in chars for a in ".a1 '" for b in ".a1 '"]
    assert [t for t, got, want in zip(texts, ids.of(texts), ids.encoded(texts), strict=True) if got != want] == []


def test_packing_words_are_asked_for_once(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, long = packing.word_ids(path), "z" * 5000
    asked, ask = [], ids.words.ask
    ids.words.clear()
    monkeypatch.setattr(ids.words, "ask", lambda w: asked.append(w) or ask(w))
    odd = ["It's 'til ''s they'llo 2nd", "", " \t\n\x0b\x0c\r ", "éa\u0301 <|x|>", f" {long}.{long}\x0b'S end", "日本 it's", "a" * 70 + "'re"] * 3
    assert ids.of(odd) == ids.encoded(odd) and ids.of([]) == []
    assert sorted(asked) == sorted([*{w for w in asked if len(w) <= packing.HELD_CHARS}, "a" * 70, long, long])
    del asked[:]
    held = packing.word_ids(path)  # the next task of a worker finds the table as it was left
    assert held is ids and held.of(odd[:1]) == ids.encoded(odd[:1]) and asked == []
    monkeypatch.setattr(packing, "HELD_WORDS", 2)
    assert held.of(odd) == ids.encoded(odd) and len(held.words) <= 2
    texts = pa.array(["abc", "", "é" * 4, "x" * 30, "", "ab"])
    assert list(packing.by_bytes(texts, 11)) == [(0, 3), (3, 1), (4, 2)] and list(packing.by_bytes(texts[:0], 9)) == []


def test_packing_windows_hold_the_target_mix(spark):
    rows = [(i, prose(i, 100), f"s{i % 3}") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"s0": 0.5, "s1": 0.3, "s2": 0.2}
    made = packing.pack(table, weights=weights, length=256, window_sequences=4).toPandas()
    early = made[made.sequence_id < 40].assign(window=lambda d: d.sequence_id // 4)
    share = early.groupby(["window", "source"]).length.sum().unstack() / 1024
    assert all(abs(share[s] - w).max() < 0.01 for s, w in weights.items())


def test_toxicity(docs, empty, spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = prose(1000 + i, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["idiotic", "moronic"])
        rows.append((i, " ".join(words), "en" if i % 3 else "fr", "s", 0, "", 0, ""))
        labels.append((i, 1, int(bad)))
    table = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, marks)
    scored = toxicity.score(table.union(docs), model).join(marks, "doc_id", "left").collect()
    assert all(0 <= r.score <= 1 for r in scored)
    held = [r for r in scored if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([(r.score >= 0.3) == (r.toxic == 1) for r in held]) > 0.97
    kept = toxicity.keep_clean(table, marks)
    assert kept.columns == table.columns and 460 < kept.count() < 500
    none = toxicity.fit(docs, marks.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_cuts_use_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 400)
    rng, rows, labels = random.Random(3), [], []
    for i in range(4000):
        bad = i % 10 == 0
        words = prose(5000 + i, 20).split()
        if bad or i % 25 == 7:  # the word alone does not tell
            words[rng.randrange(20)] = "moronic"
        if bad and i % 3:
            words[rng.randrange(20)] = "idiotic"
        rows.append((i, " ".join(words), "fr" if rng.random() < 0.04 else "en"))
        labels.append((i, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(table, marks)
    assert set(model.by_lang) == {"en", "fr"}  # 4 % of the labelled rows are French
    clean = marks.where("toxic = 0").select("doc_id")
    kept = toxicity.keep_clean(table, marks).join(clean, "doc_id").count()
    assert kept > 0.965 * clean.count()
    # 0.3 would flag half of the clean rows; the best F1 within the bound flags one of 100
    assert 0.3 < toxicity.cut_of([(0, 50, 5), (10, 49, 5), (20, 1, 5)]) < 1
    assert toxicity.cut_of([(0, 20, 2), (3, 1, 9)]) > 1 / (1 + math.exp(-3 / 64) * 7 / 3)  # too few rows for the bound
    assert toxicity.fitting([("a", 5), ("b", 90), ("c", 4)], 10) == ["a", "c"]


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    model = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    model.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    for r in token_counts.count_tokens(docs).collect():
        assert r.n_tokens == len(model.encode(r.text or "").ids)
    assert token_counts.count_tokens(empty).count() == 0
    counter = token_counts.UnigramCounter(pieces)
    for text in (" ", "  a", "a  b ", "☃☃☃ x☃y", "a\n\nb", "<unk> q", "▁▁a ▁b"):
        assert counter.text(text) == len(model.encode(text).ids), text


def test_token_ties_take_the_earliest_start():
    counter = token_counts.UnigramCounter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁ab", -3.0)])
    assert counter.text("ab") == 1  # all splits score -3


def test_arc_to_warc(spark, tmp_path):
    html = ["<p>a</p>", None, "", "x\r\n\r\nWARC/1.0\r\ny\n", "<p>a</p>", "ü" * 5000, "<p>a</p>", "last\n"]
    rows = [(i, f"http://h/{i} q", h, "extra") for i, h in enumerate(html)] + [(9, None, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string").repartition(2)
    for version in (1, 2):
        root = f"{tmp_path}/{version}"
        web_archive.write_arc(pages, f"{root}/arc", version)
        web_archive.convert_arc(spark, f"{root}/arc", f"{root}/warc")
        got = {r.page_id: r for r in web_archive.read_warc(spark, f"{root}/warc").collect()}
        assert sorted(got) == [r[0] for r in rows] and all(r.intact for r in got.values())
        for page, _, body, _ in rows:
            data, r = (body or "").encode(), got[page]
            same = [q for q, _, b, _ in rows if (b or "") == (body or "")]
            assert r.payload_bytes == len(data) and r.payload_digest == web_archive.sha1_text(data)
            assert (r.record_type, r.refers_to) == (("response", None) if page == same[0] else ("revisit", same[0]))
    with pytest.raises(ValueError, match="beyond the file"):
        list(web_archive.arc_records(b"filedesc://x 0 0 t 4\n1 0\n\nhttp://a 0 0 t 99\nshort"))


def test_vector_search(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, []), (405, [0.5, -0.25])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = vector_search.integer_vectors(table)
    usable = {i: np.asarray([math.floor(64 * np.float64(np.float32(x))) for x in v] + [0] * (8 - len(v)))
              for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    got = {}
    for r in vector_search.top_k(vectors, vectors.where("vec_id % 20 == 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [i for i in usable if i % 20 == 0]
    for q, found in got.items():
        best = sorted((-int(usable[i] @ usable[q]), i) for i in usable if i != q)[:20]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    few = vectors.where("vec_id < 3")
    assert vector_search.top_k(few, few.where("vec_id = 0")).count() == 2
    assert vector_search.top_k(few.limit(0), few.limit(0)).count() == 0


def test_vector_search_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "CHUNK", 4)  # many chunks
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)]
    rows += [(20, [float(x) for x in rng.normal(size=6)]), (20, rows[20][1]), (7, rows[40][1]), (7, rows[40][1]), (40, rows[40][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    made = [np.floor(64 * np.asarray(v)).astype(int) for _, v in rows]
    want = []
    for n, (key, _) in enumerate(rows):
        if key % 20 == 0:
            best = sorted((-int(made[m] @ made[n]), rows[m][0]) for m in range(len(rows)) if m != n)[:5]
            want += [(key, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    vectors = vector_search.integer_vectors(table)
    got = vector_search.top_k(vectors, F.col("vec_id") % 20 == 0, 5).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    elsewhere = vector_search.top_k(vectors, vectors.where("vec_id = 20"), 80).collect()  # rows of other keys only
    assert {r.vec_id for r in elsewhere} == {k for k, _ in rows} - {20} and len(elsewhere) == 3 * 62


def test_licenses(docs, empty, spark):
    lines = ["Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
             "LICENSED UNDER CC BY-NC 4.0", "Licensed under the Apache License, Version 2.0."]
    rows = [(i, f"{prose(i, 30)}\n{line}\n{prose(i + 50, 20)}") for i, line in enumerate(lines)]
    rows += [(9, "We license nothing here and the version is the public general work"), (10, None), (11, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(table, licenses.fit(table)).where("confirmed").collect()
    assert {r.doc_id: r.family for r in found} == {0: "MIT", 1: "GPL-3.0", 2: "CC-BY-NC-4.0", 3: "Apache-2.0"}
    for r in found:
        assert rows[r.doc_id][1][r.start:r.start + r.length] == lines[r.doc_id]
    assert licenses.scan(empty, licenses.fit(empty)).count() == 0


def test_wrapped_licenses(spark):
    mit, bsd, gpl = licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["BSD-3-Clause"][0], licenses.TEMPLATES["GPL-3.0"][1]
    bodies = {"MIT": "\n".join(textwrap.wrap(mit, 60)), "BSD-3-Clause": "/*\n * " + "\n * ".join(textwrap.wrap(bsd, 50)) + "\n */",
              "GPL-3.0": "dnl " + "\ndnl ".join(textwrap.wrap(gpl, 66))}
    rows = [(i, f"{prose(i, 60)}\n\n{body}\n\n{prose(i + 50, 20)}") for i, body in enumerate(bodies.values())]
    rows += [(3, f"{prose(7, 200)} {mit} {prose(8, 300)}"), (4, prose(9, 60) + "\n" + bodies["MIT"] + "\n" + prose(10, 60)),
             (5, "\n\n".join(textwrap.wrap(mit, 40)))]  # a blank line after each line: no paragraph holds the notice
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(table, licenses.fit(table)).where("confirmed").collect()
    assert sorted((r.doc_id, r.family) for r in found) == [(0, "MIT"), (1, "BSD-3-Clause"), (2, "GPL-3.0"), (3, "MIT"), (4, "MIT")]
    for r in found:
        words = licenses.words_of(rows[r.doc_id][1][r.start:r.start + r.length].replace("dnl", ""))
        assert r.share == 1 and words == licenses.words_of({"MIT": mit, "BSD-3-Clause": bsd, "GPL-3.0": gpl}[r.family])


def test_secrets(docs, empty, spark):
    key = hashlib.sha1(b"k").hexdigest()
    rows = [(1, f'the token = "{key}" of', "s"), (2, "AKIA" + "QX7TZ4LMP2VN8RWK", "s"), (3, "commit " + key + " of", "s"),
            (4, "mail geschichtlichkeit.7@mail9.example.com", "s"), (5, None, None), (6, "", "s"), (7, "x " * 50_000, "s")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = secrets.fit(secrets.labelled_findings(spark))
    found = {r.doc_id: r.secret for r in secrets.scan(table, model).collect()}
    assert found == {1: True, 2: True, 3: False, 4: False}
    assert secrets.scan(empty, model).count() == 0
    train, test = secrets.labelled_findings(spark).randomSplit([0.7, 0.3], 4)
    scored = secrets.fit(train).transform(secrets.with_features(test))
    assert scored.where("prediction = label").count() > 0.95 * scored.count()


def test_secrets_of_any_length_and_marks(spark):
    rows = [(1, "the password = hunter2secret here"), (2, "password: Xk9!vT#q2Lm@8zR."), (3, "at postgres://admin:s3cr3t!x9@db.host.com/a now"),
            (4, "the token q7!Zp3 of"), (5, "user=bob&password=aX3#9q&n=1"), (6, "title: garden"), (7, "no value here")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.scan(table, secrets.fit(secrets.labelled_findings(spark))).collect()
    wanted = {(1, "hunter2secret"), (2, "Xk9!vT#q2Lm@8zR"), (3, "s3cr3t!x9"), (4, "q7!Zp3"), (5, "aX3#9q")}
    assert {(r.doc_id, r.candidate) for r in found if r.secret} == wanted
    assert {r.candidate for r in found if r.doc_id == 6} == {"garden"} and not [r for r in found if r.doc_id == 7]
    twice = spark.createDataFrame([(1, "token = " + "aB3" * 9)], "doc_id long, text string")
    assert secrets.candidates(twice).count() == 1


def test_secrets_in_lines_without_end(spark):
    """Ten million characters without a blank, of every separator: time in proportion to the text."""
    units = ["7,", "7&", "a?", "7;", "a{", "a(", "f(f{", "a=", "a:", "a=>", 'a"', "a[", "a['b']", "x://a:", "a=b,", "a=1&", "key=", "@a", "x", ",", "=", "-_", "aB3"]
    rows = [(i, f"token = q7!Zp3x {u * (10_000_000 // len(u))} end") for i, u in enumerate(units)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    started = time.monotonic()
    found = secrets.candidates(table).groupBy("doc_id").agg(F.max(F.col("candidate") == "q7!Zp3x").alias("first")).collect()
    assert {r.doc_id for r in found if r.first} == set(range(len(units))) and time.monotonic() - started < 120
    scored = secrets.with_features(secrets.candidates(table.where("doc_id in (18, 22)"))).count()
    assert scored == 4


def test_secrets_behind_names_of_any_kind(spark):
    rows = [(1, 'config["password"] = "s3cr3t!x"'), (2, "пароль: тайна9"), (3, "(user=bob,pwd=k4#9)"), (4, "TOKEN='abc-1!'"), (5, '"api_key" : "z9!q"')]
    found = secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = {(1, "s3cr3t!x"), (2, "тайна9"), (3, "bob"), (3, "k4#9"), (4, "abc-1!"), (5, "z9!q")}
    assert wanted <= {(r.doc_id, r.candidate) for r in found}


def test_secret_path_changes_a_score(spark):
    texts = ["key = garden7", "password: ada12ent", "token = 4821", "auth stone9"]
    rows = [(i, t, p) for i, t in enumerate(texts) for p in ("src/main.py", "tests/test_app.py")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = secrets.fit(secrets.labelled_findings(spark))
    scored = secrets.scan(table, model).groupBy("doc_id").agg(F.max("probability") - F.min("probability"))
    assert any(r[1] > 0.001 for r in scored.collect())


def test_toxicity_maxima_equal_a_plain_convolution(monkeypatch):
    monkeypatch.setattr(toxicity, "SLICE", 7)  # texts are cut, and slices overlap
    rng = np.random.default_rng(3)
    net = toxicity.Network.fresh(5)
    net.bias, net.out = rng.normal(size=net.bias.shape).astype(np.float32), rng.normal(size=net.out.shape).astype(np.float32)
    model = toxicity.Toxicity(net, 0.0, 0.3, {})
    texts = ["", "one", "one two", "ONE two three", prose(1, 7), prose(2, 8), prose(3, 60), prose(4, 6) + " " + prose(4, 6)]
    got = model.score_texts(texts, toxicity.WordRows())
    for text, score in zip(texts, got, strict=True):
        held = toxicity.WordRows()
        pairs = np.asarray([held.pairs[held[w]] for w in toxicity.words_of(text)], np.int64).reshape(-1, 2)
        vectors = net.embedding[pairs[:, 0]] + net.embedding[pairs[:, 1]]
        top = []
        for kernel in net.filters:
            width = len(kernel)
            sums = [sum(vectors[i + j] @ kernel[j] for j in range(width)) for i in range(len(vectors) - width + 1)]
            top.append(np.max(sums, 0) if sums else np.full(toxicity.FILTERS, -np.inf))
        hidden = np.maximum(np.concatenate(top) + net.bias, 0)
        assert score == pytest.approx(1 / (1 + np.exp(-(hidden @ net.out + net.out_bias))), abs=1e-5)


def test_toxicity_scores_each_text_once(spark, monkeypatch):
    rows = [(i, prose(i, 20) + (" idiotic" if i % 4 == 0 else ""), "en", 0.5) for i in range(800)] + [(None, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    calls = []
    monkeypatch.setattr(toxicity, "score", lambda *a, f=toxicity.score, **k: calls.append(1) or f(*a, **k))
    model, scored = toxicity.fit_and_score(table, marks, keep=["doc_id", "lang"])
    assert len(calls) == 1 and scored.columns == ["doc_id", "lang", "score"] and scored.count() == 801
    kept = toxicity.keep_clean(table, marks)
    assert kept.columns == table.columns and len(calls) == 3 and 580 < kept.count() <= 601
    assert {r.score for r in kept.collect()} <= {0.5, None}  # a column of that name is passed on
    assert toxicity.score(table, model).columns == ["doc_id", "text", "lang", "score"]
