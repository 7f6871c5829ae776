"""Operators against brute-force versions, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter
from unittest.mock import MagicMock

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import cas_store, edit_counts, fair_mix, grace_dedup, gru_lm, quality_ledger, sparse_jaccard, toxic_crf, trie_bpe, url_cascade
from tidemark.llm.common import lean, most_counted
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
ALPHABET = "ab re'sst'll\n\n  \t<|endoftext|>éß漢字😀́\xa0 \x1c\x85AIİ12٣ 's.,"
DOCS = "doc_id long, text string, source string, kept string, score double"


def strings(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(80))) for _ in range(n)] + ["", " ", "a<|endoftext|> b", "ΑΣ ς", "x" * 3000, "End. Of, it!"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, ties, repeated rows, a long text, clashing names."""
    long = " ".join(f"w{i % 701}" for i in range(20000))
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", None), (2, "a b c d e f", None), (3, None, "x"), (None, "a  b c d e f", "y"), (4, "", "y"), (5, " \n", "x"), (6, long, "z"), (7, long + " end", "z"), (8, "q " * 60, None)]
    return spark.createDataFrame([(*r, "k", 0.5) for r in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def test_bpe_is_the_library(spark):
    path = public_tokenizers.path(trie_bpe.TOKENIZER)
    own, library = trie_bpe.Bpe(path), Tokenizer.from_file(path)
    texts = strings(800)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_bpe_query_against_the_library(spark, odd, empty):
    path = public_tokenizers.path(trie_bpe.TOKENIZER)
    library, r = Tokenizer.from_file(path), random.Random(3)

    def by_hand(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))

    long = spark.createDataFrame([(91, "".join(r.choice("abcdeüж") for _ in range(90_000)), None, "k", 0.5), (92, "a" * 70_000 + " b", None, "k", 0.5)], DOCS)
    for df in (odd.unionByName(long), empty, spark.read.parquet(f"{SF}/documents.parquet")):
        got = sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in trie_bpe.digest_documents(df, path).collect())
        assert got == sorted((str(x.doc_id), *by_hand(x.text)) for x in df.collect())


def test_store_round_trip(spark, tmp_path, odd, empty):
    path = public_tokenizers.path(cas_store.TOKENIZER)
    library = Tokenizer.from_file(path)
    marks = [f"{a}{chr(m)}{b}" for a in "TtHWwYyJ" for m in (0x308, 0x331, 0x30A, 0x30C, 0x345, 0x338) for b in ("", "x", ".", ", Ab")]
    texts = strings(300) + marks + ["one (two). Three?! a.b c,d 5. '' it's. \u212a. K. <|", "Word.\tWord,\nWord;\x0bWord:", "é, é... ü!!! ×! ÷, ž; Ž; ß. ſ. ŉ, ª. µ, ĳ. word!!!!!!!!!! word!?.,;: x", "!a ,b .", ".", "é", "Éa Ωa ωa, жж! 漢,"] + ["the same passage of a text " * 400] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    cas_store.write_store(docs, str(tmp_path / "s"), path)
    want = [[*e.ids, 1] for e in library.encode_batch(texts, add_special_tokens=False)]
    starts = np.cumsum([0, *map(len, want)]).tolist()
    assert [(r.doc_id, r.start, r.ids) for r in cas_store.read_ids(spark, str(tmp_path / "s")).orderBy("doc_id").collect()] == [(i, starts[i], w) for i, w in enumerate(want)]
    digests = cas_store.read_digests(spark, str(tmp_path / "s")).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.ids_crc32) for r in digests] == [(len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for w in want]
    for name, df in (("o", odd), ("e", empty)):
        cas_store.write_store(df, str(tmp_path / name), path)
        rows = sorted(((r.doc_id is not None, r.doc_id or 0), [*library.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in df.collect())
        got = [((r.doc_id is not None, r.doc_id or 0), r.start, r.ids) for r in cas_store.read_ids(spark, str(tmp_path / name)).orderBy("start").collect()]
        starts = np.cumsum([0, *(len(ids) for _, ids in rows)]).tolist()
        assert got == [(i, s, ids) for (i, ids), s in zip(rows, starts, strict=False)]
        assert sorted((r.start, r.n_tokens) for r in cas_store.read_digests(spark, str(tmp_path / name)).collect()) == [(s, len(ids)) for _, s, ids in got]


def test_merkle_root_is_level_by_level():
    for n in range(20):
        leaves = [bytes([i]) * 32 for i in range(n)]
        level = leaves or [hashlib.sha256(b"").digest()]
        while len(level) > 1:
            level = [hashlib.sha256(b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        assert cas_store.merkle_root(leaves) == level[0]


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "s")
    cas_store.write_store(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), path, public_tokenizers.path(cas_store.TOKENIZER))
    spark.read.parquet(f"{path}/chunks").withColumn("payload", F.lit(b"\1\0")).write.parquet(f"{path}/other")
    import shutil

    shutil.rmtree(f"{path}/chunks")
    shutil.move(f"{path}/other", f"{path}/chunks")
    with pytest.raises(Exception, match="damaged"):
        cas_store.read_digests(spark, path).collect()


def test_recipes_stand_in_document_order(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "s")
    docs = spark.createDataFrame([(i * 7919 % 1000, f"text {i}") for i in range(1000)], "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cas_store.write_store(docs, path, public_tokenizers.path(cas_store.TOKENIZER))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "s" / "recipes").glob("part-*"))
    rows = [(r["doc_id"], r["range"], r["inside"]) for f in files for r in pq.read_table(f).to_pylist()]
    assert len(files) > 1 and [d for d, _, _ in rows] == list(range(1000)) and rows == sorted(rows, key=lambda r: r[1:])
    starts = [r.start for r in cas_store.read_digests(spark, path).orderBy("doc_id").collect()]
    assert starts == sorted(starts)


def test_lost_recipes_are_found(spark, tmp_path):
    path = str(tmp_path / "s")
    cas_store.write_store(spark.createDataFrame([(i, f"a b c{i}") for i in range(40)], "doc_id long, text string").repartition(3), path, public_tokenizers.path(cas_store.TOKENIZER))
    assert cas_store.read_digests(spark, path).count() == 40
    recipes = spark.read.parquet(f"{path}/recipes")
    recipes.where("doc_id <> 39").write.parquet(f"{path}/less")
    recipes.withColumn("inside", F.when(F.col("doc_id") == 17, F.col("inside") + 1).otherwise(F.col("inside"))).write.parquet(f"{path}/moved")
    import shutil

    for other in ("less", "moved"):
        shutil.rmtree(f"{path}/recipes")
        shutil.copytree(f"{path}/{other}", f"{path}/recipes")
        for read in (cas_store.read_digests, cas_store.read_ids):
            with pytest.raises(Exception, match="differs?"):
                read(spark, path)


def test_edits_equal_recounting():
    path = public_tokenizers.path(trie_bpe.TOKENIZER)
    own, library, r = edit_counts.counter(path), Tokenizer.from_file(path), random.Random(2)
    library.encode_special_tokens = True
    for text in strings(300):
        tree = edit_counts.CountTree.of(text, own.cut, own)
        for k in range(4):
            i = r.randrange(len(text) + 1)
            j, new = min(len(text), i + r.choice([0, 1, 5, 30])), "".join(r.choice(ALPHABET) for _ in range(r.choice([0, 1, 9])))
            tree.edit(i, j, new)
            text = text[:i] + new + text[j:]
            assert tree.text() == text and tree.total == len(library.encode(text, add_special_tokens=False).ids)
            if k == 1:  # kept and read again
                tree = edit_counts.CountTree(text, *tree.leaves(), own.cut, own)


def test_edit_query_against_recounting(spark, odd, empty):
    path = public_tokenizers.path(trie_bpe.TOKENIZER)
    library, rules = Tokenizer.from_file(path), regex.compile("|".join(f"({p})" for p, _ in edit_counts.REDACTIONS))
    library.encode_special_tokens = True
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)

    def by_hand(text):
        edits = list(rules.finditer(text or ""))
        return count(text or ""), len(edits), count(rules.sub(lambda m: edit_counts.REDACTIONS[m.lastindex - 1][1], text or ""))

    more = spark.createDataFrame([(90, f"write to a.b+{'c' * 30}@d-e.org or +49 (0)30 1234-567, key {'k9_' * 9}! " * 3, "x", "k", 0.5)], DOCS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = edit_counts.op6_edit_counts(spark, SF).collect()
    key = lambda x: (str(x[0]), *x[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after) for r in got), key=key) == sorted(((r.doc_id, *by_hand(r.text)) for r in docs.collect()), key=key)
    trees = edit_counts.build_trees(odd.unionByName(more), path)
    once = edit_counts.edit_trees(trees, path, with_trees=True).cache()
    assert sorted(((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after) for r in once.collect()), key=key) == sorted(((r.doc_id, *by_hand(r.text)) for r in odd.unionByName(more).collect()), key=key)
    twice = edit_counts.edit_trees(once, path, lambda text: [(0, min(1, len(text)), "Zed ")])
    want = sorted(((r.doc_id, r.n_tokens_after, count("Zed " + r.text[1:])) for r in once.collect()), key=key)
    assert sorted(((r.doc_id, r.n_tokens, r.n_tokens_after) for r in twice.collect()), key=key) == want
    assert max(r.n_recut for r in got if r.n_edits) < max(r.n_tokens for r in got) and edit_counts.edit_trees(edit_counts.build_trees(empty, path), path).count() == 0


def test_jaccard_is_brute_force(spark, odd, empty):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = [r.choice(words) for _ in range(r.choice([3, 5, 40, 90]))]
        for k in range(r.choice([1, 2, 4])):
            copy = [r.choice(words) if r.random() < 0.01 * k else w for w in base]
            rows.append((10 * i + k, " ".join(copy[: len(copy) - k])))
    passage = " ".join(words[:60])
    rows += [(1000 + i, f"{passage} " + " ".join(r.choice(words) for _ in range(12))) for i in range(40)]
    for i in range(150):  # one group with many pairs on either side of the threshold
        changed = r.sample(range(60), r.choice([0, 1, 2, 3]))
        rows.append((2000 + i, " ".join(r.choice(words) if k in changed else w for k, w in enumerate(words[100:160]))))
    odd_rows = [(x.doc_id, x.text) for x in odd.collect()]
    for df, want in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (odd, odd_rows), (empty, [])):
        got = sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in sparse_jaccard.jaccard_join(df).collect())
        assert got == brute_components(want)


def links_by_hand(rows):
    sets = [(d, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set()) for d, t in rows]
    link = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    return sorted((str(d), sum(link(s, t) for _, t in sets) - bool(s)) for d, s in sets)


def near_copies(n, seed=6, words=60):
    """One group whose members are not all linked."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        changed = r.sample(range(words), r.choice([0, 1, 2, 3]))
        out.append((i, " ".join(f"x{r.randrange(99)}" if k in changed else f"w{k}" for k in range(words))))
    return out


@pytest.mark.parametrize("dense, tile", [(64, 1_000_000), (8, 1_500), (1 << 30, 1_000_000)])
def test_join_finds_every_link(spark, odd, empty, monkeypatch, dense, tile):
    monkeypatch.setattr(sparse_jaccard, "DENSE", dense)
    monkeypatch.setattr(sparse_jaccard, "TILE_ELEMENTS", tile)
    group = near_copies(80) + [(i + 200, t + " " + " ".join(f"y{k}" for k in range(i % 9))) for i, t in near_copies(60, 8)] + [(300, "a b"), (301, "A  b"), (302, None)]
    for df in (spark.createDataFrame(group, "doc_id long, text string"), odd, empty):
        rows = [(x.doc_id, x.text) for x in df.collect()]
        got = sparse_jaccard.jaccard_join(df).collect()
        assert sorted((str(x.doc_id), x.n_links) for x in got) == links_by_hand(rows)
        assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == brute_components(rows)


def test_large_groups_send_no_pairs(spark, monkeypatch):
    sent, keep = [], sparse_jaccard.staged

    def watched(df, label):
        out = keep(df, label)
        if label in ("jaccard-cells", "jaccard-marked", "jaccard-links", "jaccard-tiles"):
            sent.append(out.count())
        return out

    monkeypatch.setattr(sparse_jaccard, "staged", watched)
    totals = []
    for n in (200, 400, 800):
        sent.clear()
        rows = sparse_jaccard.jaccard_join(spark.createDataFrame(near_copies(n, 9), "doc_id long, text string")).collect()
        totals.append((sum(sent), sum(x.n_links for x in rows)))
    assert all(b[0] < 2.6 * a[0] and b[1] > 3 * a[1] for a, b in zip(totals, totals[1:], strict=False))


def test_colliding_names_are_done_again(spark, monkeypatch):
    ids = sparse_jaccard.set_ids
    monkeypatch.setattr(sparse_jaccard, "set_ids", lambda s, seed: (ids(s, seed)[0] if seed else 7, ids(s, seed)[1]))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k l")]
    monkeypatch.setattr(sparse_jaccard, "staged", lambda df, label, keep=sparse_jaccard.staged: keep(df, label))
    got = sparse_jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.component_id, x.n_links) for x in got) == [(1, 1, 1), (2, 1, 1), (3, 3, 0)]


def test_blocks_of_the_product():
    r = np.random.Generator(np.random.PCG64(3))
    sets = [np.unique(r.integers(0, 1 << k, 90).astype(np.uint64)) for k in (7, 7, 8, 9, 20, 20, 7, 8)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert sparse_jaccard.block_product(sets, sets).tolist() == want
    assert sparse_jaccard.block_product(sets[:3], sets[3:]).tolist() == [w[3:] for w in want[:3]]
    owner = np.array([0, 0, 2, 1])
    assert sparse_jaccard.masked_overlaps(sets[:3], sets[3:7], owner).tolist() == [want[o][3 + i] for i, o in enumerate(owner)]
    for a in sets:
        for b in sets:
            bound = sparse_jaccard.most_overlap(sparse_jaccard.histogram(a << np.uint64(40)), sparse_jaccard.histogram(b << np.uint64(40)), len(a), len(b))
            assert bound >= len(np.intersect1d(a, b))


def test_dedup_compares_contents(spark, odd, empty):
    want = {}
    for x in odd.collect():
        key = "".join((x.text or "").encode().translate(None, grace_dedup.BLANKS).decode())
        want.setdefault(key, []).append((-len(x.text or ""), x.doc_id if x.doc_id is not None else 1 << 60))
    for bits, leaf in ((64, 1 << 26), (2, 64)):
        rows = grace_dedup.exact_groups(odd, leaf, bits).collect()
        assert sum(x.kept for x in rows) == len(want) and len(rows) == 10
        for key, members in want.items():
            sha = hashlib.sha256(key.encode()).hexdigest()
            keep = min(members)[1]
            assert {(x.keep_id, x.group_size) for x in rows if x.text_sha256 == sha} == {(None if keep == 1 << 60 else keep, len(members))}
    assert grace_dedup.exact_groups(empty).count() == 0


def test_words_are_looked_up_once_a_group(monkeypatch):
    path, asked = public_tokenizers.path(cas_store.TOKENIZER), []

    class Counted(cas_store.WordIds):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(cas_store, "_words", {path: Counted(path)})
    list(cas_store.encode_texts([b"some words " * 500] * 20, path))
    assert len(asked) == 2
    library = Tokenizer.from_file(path)
    texts = ["", "x" * 16 + " " + "x" * 17 + " " + "x" * 15, "a\0 a \0 a\0\0 a", ("y" * 50 + " ") * 3 + "y" * 49 + "z", *strings(300, 12)]
    for i in range(0, len(texts), 7):
        got = list(cas_store.encode_texts([t.encode() for t in texts[i : i + 7]], path, b"\1\0\0\0"))
        want = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts[i : i + 7]]
        assert np.frombuffer(got[0][0], "<u4").tolist() == [x for ids in want for x in ids]
        assert got[0][1] == np.cumsum([len(ids) for ids in want]).tolist()


def test_tiles_take_little_memory():
    r = np.random.Generator(np.random.PCG64(4))
    base = r.integers(0, 1 << 48, 500, np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(500) < 0.9], r.integers(0, 3000, 60, np.uint64)])) for _ in range(2000)]
    n = np.array([len(x) for x in sets])
    tracemalloc.start()
    overlap = sparse_jaccard.block_product(sets, sets)
    link = sparse_jaccard.linked(overlap, n, n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6
    for i in (0, 255, 256, 1999):
        assert overlap[i].tolist() == [len(np.intersect1d(sets[i], x, True)) for x in sets]
        assert link[i].tolist() == [100 * o >= 75 * (int(n[i]) + len(x) - o) for o, x in zip(overlap[i].tolist(), sets, strict=True)]


def test_workers_keep_nothing_of_other_operators(spark):
    docs = spark.createDataFrame([(1, "a toxic tale"), (2, "b c d e f g")], "doc_id long, text string").coalesce(1)

    def kept(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(trie_bpe._loaded)] * batch.num_rows, pa.int64())], ["n"])

    trie_bpe.bpe(public_tokenizers.path(trie_bpe.TOKENIZER))
    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["x"])
    assert [b.column(0).to_pylist() for b in kept(iter([batch]))] == [[1]]
    assert [b.column(0).to_pylist() for b in lean(kept)(iter([batch]))] == [[0]]
    path = public_tokenizers.path(trie_bpe.TOKENIZER)
    want = sorted(trie_bpe.digest_documents(docs, path).collect())
    assert sparse_jaccard.jaccard_join(docs).count() == 2
    assert sorted(trie_bpe.digest_documents(docs, path).collect()) == want


def test_cascade_is_exact(spark):
    keys = [f"h{i}.org" for i in range(3000)]
    listed = keys[::7]
    df = lambda x: spark.createDataFrame([(k,) for k in x], "key string")
    cascade = url_cascade.build_cascade(df(listed), df(keys))
    assert [k for k in keys if k in cascade] == listed and len(cascade.levels) > 1 and cascade.depths == (2,)
    assert cascade.lists("a.b.h7.org") and not cascade.lists("a.h8.org") and not cascade.lists("org")
    with pytest.raises(ValueError):
        url_cascade.build_cascade(df(listed), df(keys), max_bytes=10)
    deep = ".".join(["x"] * 20_000)
    rows = [(1, None, "", "allow"), (2, "nope", "", "allow"), (3, "http://WWW.Free-Bets.example.net?x", "www.free-bets.example.net", "block"), (3, "http://WWW.Free-Bets.example.net?x", "www.free-bets.example.net", "block"),
            (4, f"://{deep}.cheap-pills.example.org/p", f"{deep}.cheap-pills.example.org", "block"), (5, "x://..", "..", "allow"), (None, "http://example.com/en/77#a", "example.com", "allow"), (7, "http://cheap-pills.example.org.net/" + "y" * 50_000, "cheap-pills.example.org.net", "allow")]
    odd = spark.createDataFrame([(i, u, "x") for i, u, _, _ in rows], "page_id long, url string, host string")
    got = url_cascade.judge_urls(odd, df(url_cascade.LISTED_HOSTS)).collect()
    assert sorted((str(x.page_id), x.host, x.verdict) for x in got) == sorted((str(i), h, v) for i, _, h, v in rows)
    assert url_cascade.judge_urls(odd.limit(0), df([])).count() == 0


def test_ledger_policies_and_ablation(spark, odd, empty):
    rows = quality_ledger.ledger(odd)
    policy = quality_ledger.POLICIES["2"]
    bits = [x.fail_bits & policy.mask for x in rows.collect()]
    for x in quality_ledger.ablation(rows, policy).collect():
        own = 1 << next(r.bit for r in quality_ledger.QUALITY_RULES if r.name == x.rule)
        assert (x.n_failed, x.n_failed_alone, x.n_kept_without) == (sum(bool(b & own) for b in bits), bits.count(own), sum(not b & ~own for b in bits))
    assert quality_ledger.ledger(empty).count() == 0


def mix_by_hand(rows):
    sizes = [len((t or "").encode().split()) for _, t, _ in rows]
    sources = sorted({x[2] for x in rows}, key=lambda v: (v is None, v or ""))
    total = {v: sum(n for n, x in zip(sizes, rows, strict=True) if x[2] == v) for v in sources}
    weight = {v: (5, 2, 1)[i % 3] for i, v in enumerate(sources)}
    target, budget = {}, 1.5 * sum(sizes)
    while True:  # reshare until none is above
        left = [v for v in sources if v not in target]
        share = (budget - sum(target.values())) / sum(weight[v] for v in left) if left else 0
        over = [v for v in left if weight[v] * share > 2 * total[v]]
        if not over:
            target |= {v: weight[v] * share for v in left}
            break
        target |= {v: 2.0 * total[v] for v in over}
    digest = lambda d, t: hashlib.md5(f"{'' if d is None else d}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()
    copies, taken = [], Counter()
    for place, v in enumerate(sources):
        queue = sorted((digest(d, t), n, i) for i, ((d, t, s), n) in enumerate(zip(rows, sizes, strict=True)) if s == v)
        end = 0
        for h, n, i in [*queue, *queue]:
            end += n
            copies.append((end / target[v] if target[v] else math.inf, place, h, n, i))
    upto = 0
    for *_, n, i in sorted(copies):
        upto += n
        if upto > budget:
            break
        taken[i] += n
    return [(d, n, total[s], round(target[s], 6), taken[i]) for i, ((d, _, s), n) in enumerate(zip(rows, sizes, strict=True))]


def test_mix_meets_targets(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = fair_mix.mix(docs).collect()
    total, largest = sum(x.size for x in rows), max(x.size for x in rows)
    by = {}
    for x in rows:
        assert x.taken in (0, x.size, 2 * x.size) and x.target <= 2 * x.source_size + 1e-6
        got = by.setdefault(x.source, [0, x.target])
        got[0] += x.taken
    assert math.isclose(sum(t for _, t in by.values()), 1.5 * total) and all(abs(n - t) <= 2 * largest for n, t in by.values())
    assert fair_mix.mix(empty).count() == 0
    for df in (docs, odd.unionByName(odd).repartition(3)):
        got = sorted(str((x.doc_id, x.size, x.source_size, round(x.target, 6), x.taken)) for x in fair_mix.mix(df).collect())
        assert got == sorted(map(str, mix_by_hand([(x.doc_id, x.text, x.source) for x in df.collect()])))


def test_chain_marginals():
    r = np.random.Generator(np.random.PCG64(1))
    crf = toxic_crf.Crf(np.zeros(1), 0.0, r.normal(size=(2, 2)), 0.3, np.zeros(3))
    e, first = r.normal(size=9), np.array([1, 0, 0, 0, 1, 0, 0, 0, 0], bool)
    want = []
    for a, b in ((0, 4), (4, 9)):
        total, hit = 0.0, np.zeros(b - a)
        for states in np.ndindex(*[2] * (b - a)):
            s = 0.3 * states[0] + sum(e[a + i] * x for i, x in enumerate(states)) + sum(crf.trans[x, y] for x, y in zip(states, states[1:], strict=False))
            total += np.exp(s)
            hit += np.exp(s) * np.array(states)
        want += list(hit / total)
    assert np.allclose(crf.marginals(e, first), want)


def test_field_learns_from_whole_texts(monkeypatch):
    seen, fit, r = [], toxic_crf._fit, random.Random(7)

    def watched(crf, sample, table, hit, starts, lengths, random):
        for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
            seen.extend((sample.vocabulary[sample.flat[i]], bool(hit[i])) for i in range(start, start + n))
        assert max(lengths) <= 2 * toxic_crf.REACH + 1
        fit(crf, sample, table, hit, starts, lengths, random)

    monkeypatch.setattr(toxic_crf, "_fit", watched)
    texts = [[f"c{r.randrange(40)}" for _ in range(300 + k)] for k in range(30)] + [[], ["c1"]] + [["vile" if i % 60 == 5 else f"c{r.randrange(40)}" for i in range(200)] for _ in range(30)]
    crf = toxic_crf.train_crf(texts, [k >= 32 for k in range(62)])
    assert Counter(w for w, _ in seen) == Counter(w for words in texts for w in words)
    assert {w for w, hit in seen if hit} == {"vile"}
    assert judged_by_hand(crf, " ".join(texts[40]))[0] > 0.9 > 0.1 > judged_by_hand(crf, " ".join(texts[3]))[0]


def test_toxicity_on_held_out_rows(spark, odd, empty):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(x.toxic, x.predicted) for x in QUERIES["op5_toxic_crf"](spark, sf).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()]
    n = Counter(rows)
    assert n[1, 1] >= 0.85 * (n[1, 1] + n[1, 0]) and n[0, 1] <= 0.01 * (n[0, 0] + n[0, 1])
    assert toxic_crf.score_documents(odd, None).count() == 10 and toxic_crf.score_documents(empty, None).count() == 0


def judged_by_hand(crf, text):
    """score, words above 1/2 and their spans, by sums over both states of every word."""
    words = [(m.start(), m.end(), m.group()) for m in re.finditer("[^\\x20\\x09-\\x0D]+", text or "")]
    e = [crf.emission(toxic_crf.plain(w.encode())) for _, _, w in words]
    log = lambda a, b: np.logaddexp(a, b)
    ahead, p, t = [], [], crf.trans
    for i, x in enumerate(e):
        ahead.append((0.0, crf.start + x) if not i else tuple(log(ahead[-1][0] + t[0, s], ahead[-1][1] + t[1, s]) + x * s for s in (0, 1)))
    behind = (0.0, 0.0)
    for i in range(len(e) - 1, -1, -1):
        both = [ahead[i][s] + behind[s] for s in (0, 1)]
        p.append(math.exp(both[1] - log(*both)))
        behind = tuple(log(t[s, 0] + behind[0], t[s, 1] + e[i] + behind[1]) for s in (0, 1))
    p, spans, before = p[::-1], [], -2
    for i, (start, end, _) in enumerate(words):
        if p[i] > 0.5:
            if before == i - 1:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
            before = i
    n, largest = sum(x > 0.5 for x in p), min(max(max(p, default=0), 1e-6), 1 - 1e-6)
    x = crf.score @ np.array([math.log(largest / (1 - largest)), math.log1p(n), 1])
    return 1 / (1 + math.exp(-min(max(x, -30), 30))), n, spans


def test_toxicity_query_against_plain_sums(spark, odd, empty, monkeypatch):
    fits, fit = [], toxic_crf.fit
    monkeypatch.setattr(toxic_crf, "fit", lambda *a: fits.append(fit(*a)) or fits[-1])
    rows = QUERIES["op5_toxic_crf"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for x in rows:
        score, n, spans = judged_by_hand(fits[0], texts[x.doc_id])
        assert math.isclose(x.score, score, rel_tol=1e-5, abs_tol=1e-9) and (x.n_toxic_words, [tuple(s) for s in x.spans]) == (n, spans)
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and x.predicted == int(x.score >= 0.5)
    # the trained field meets nulls, empties and repeated rows
    got = sorted((str(x.doc_id), round(x.score, 6), x.n_toxic_words) for x in toxic_crf.score_documents(odd, fits[0]).collect())
    assert got == sorted((str(x.doc_id), round(judged_by_hand(fits[0], x.text)[0], 6), judged_by_hand(fits[0], x.text)[1]) for x in odd.collect())
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxic_crf.fit(odd, labels) is None and {x.score for x in toxic_crf.score_documents(odd, None).collect()} == {0.0}
    assert toxic_crf.score_documents(empty, fits[0]).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 10) for i in range(40)] + [(7, f"other {k}") for k in range(50)] + [(8, "long " * 500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    rows, sizes = toxic_crf.read_sample(docs, labels, F.lit(True), 15, 100)
    texts, toxic = [bytes(r.text).split() for r in rows.orderBy("label_id").collect()], [r.toxic for r in rows.orderBy("label_id").collect()]
    assert len(texts) == len(toxic) and 8 <= sum(toxic) <= 15 and 8 <= toxic.count(False) <= 10
    assert sum(len(t) for t, k in zip(texts, toxic, strict=True) if not k) <= 100 and max(map(len, texts)) <= 100
    assert sizes == {False: 20, True: 20}


def plain_score(model, known, counts, words):
    """A loop over the words, with 64-bit numbers; known: the model's own tokens by rank."""
    p, size, h = {k: v.astype(float) for k, v in model.p.items()}, model.classes, np.zeros(gru_lm.HIDDEN)
    sigmoid, ending = (lambda v: 1 / (1 + np.exp(-v))), (lambda w: zlib.crc32(w[-3:]) % size)
    rest = Counter(dict.fromkeys(range(size), 1))
    for w, c in counts.items():
        if w not in known:
            rest[ending(w)] += c + 1
    log_softmax = lambda v: v - v.max() - np.log(np.exp(v - v.max()).sum())
    total, last, n = 0.0, gru_lm.START, gru_lm.HIDDEN
    for w in words:
        a, b = p["x"][last], h @ p["u"] + p["bu"]
        z, r = sigmoid(a[:n] + b[:n]), sigmoid(a[n : 2 * n] + b[n : 2 * n])
        h = h + z * (np.tanh(a[2 * n :] + r * b[2 * n :]) - h)
        state = np.append(h, 1)
        if w in known:
            last = known[w]
            total += log_softmax(state @ p["wc"])[last // size] + log_softmax(state @ p["wo"][last // size])[last % size]
        else:
            last = size * size + ending(w)
            total += log_softmax(state @ p["wc"])[size + ending(w)] + math.log((counts[w] + 1) / rest[ending(w)])
    return total / math.log(10)


@pytest.fixture
def trained(monkeypatch):
    """The models that were trained, and the rows they learnt from."""
    seen, train = [], gru_lm._train

    def watched(texts, *rest):
        seen.append((train(texts, *rest), sorted(bytes(r.ids) for r in texts.collect())))
        return seen[-1][0]

    monkeypatch.setattr(gru_lm, "_train", watched)
    return seen


def check_scores(rows, texts, held, model):
    counts = Counter(w for i, t in texts if not held(i) for w in gru_lm.tokens((t or "").encode()))
    total, distinct = sum(counts.values()), len(counts)
    known = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w))[: model.classes**2])}
    want = []
    for i, t in texts:
        words = gru_lm.tokens((t or "").encode())
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        want.append((str(i), held(i), len(words), sum(counts[w] > 0 for w in words), total, base, plain_score(model, known, counts, words)))
    key = lambda x: (x[0], x[2], round(x[5], 6))
    got = sorted(((str(x.doc_id), x.held_out, x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in rows), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-4)


def test_scores_against_a_plain_loop(spark, odd, empty, trained):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op10_gru_lm"](spark, SF).collect()
    check_scores(rows, texts, lambda i: zlib.crc32(str(i).encode()) % 7 == 2, trained[0][0])
    gain = sum(x.score - x.base_score for x in rows if x.held_out)
    assert gain > 0.05 * sum(x.n_tokens for x in rows if x.held_out)
    check_scores(gru_lm.score_documents(odd, F.coalesce(F.col("doc_id") != 3, F.lit(True))).collect(), [(r.doc_id, r.text) for r in odd.collect()], lambda i: i == 3, trained[1][0])
    assert gru_lm.score_documents(empty, F.lit(True)).count() == 0
    check_scores(gru_lm.score_documents(odd, F.lit(False)).collect(), [(r.doc_id, r.text) for r in odd.collect()], lambda i: True, trained[3][0])


def test_every_training_text_is_learnt_from(spark, trained):
    docs = spark.createDataFrame([(i, f"a b w{i}") for i in range(40)], "doc_id long, text string")
    gru_lm.score_documents(docs, F.col("doc_id") % 4 != 0).collect()
    counts = Counter(w for i in range(40) if i % 4 for w in gru_lm.tokens(f"a b w{i}".encode()))
    ranks = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w)))}
    assert trained[0][1] == sorted(np.array([ranks[w] for w in gru_lm.tokens(f"a b w{i}".encode())], np.int32).tobytes() for i in range(40) if i % 4)


def test_every_token_is_learnt_from(monkeypatch):
    model, seen, window = gru_lm.Gru(np.arange(50, 0, -1.0), 10.0), [], gru_lm.Gru.window

    def watched(self, h, ids, targets, live=None):
        seen.extend((targets if live is None else targets[live]).ravel().tolist())
        return window(self, h, ids, targets, live)

    monkeypatch.setattr(gru_lm.Gru, "window", watched)
    texts = [np.arange(n, dtype=np.int32) % 60 for n in (5, 777, 1, 3001)]
    assert model.train(texts) == 3784 and Counter(seen) == Counter(np.concatenate(texts).tolist())


def test_ties_go_by_a_hash_of_the_word(spark):
    counts = spark.createDataFrame([(f"t{i:02}".encode(), 3) for i in range(50)] + [(b"z", 9)], "w binary, c long")
    kept = most_counted(counts, "w", 40)
    assert kept[0] == (b"z", 9) and 35 <= len(kept) <= 40 and kept == most_counted(counts.repartition(3), "w", 40) and set(kept) <= {(bytes(r.w), r.c) for r in counts.collect()}
    assert most_counted(counts, "w", 60)[0] == (b"z", 9) and len(most_counted(counts, "w", 60)) == 51


def test_vocabulary_grows_and_gives_a_distribution(spark):
    r = random.Random(5)
    words = [f"w{r.randrange(100)}" if i % 3 else f"v{i}x{r.choice('abc')}" for i in range(30_000)] + [f"u{i}" for i in range(60_000)]
    counts = gru_lm.count_tokens(spark.createDataFrame([(" ".join(words).encode(),)], "text binary")).cache()
    distinct = counts.count()
    classes = gru_lm.class_count(distinct)
    assert gru_lm.class_count(100) == gru_lm.LEAST_CLASSES < classes < gru_lm.class_count(100 * distinct)
    v = gru_lm.Vocabulary(most_counted(counts, "w", gru_lm.BROADCAST_WORDS), classes, gru_lm.ending_sums(counts, classes))
    assert v.n_known == classes**2 > 1024
    share, places = np.ones(classes), classes**2  # of the unseen words of each class
    rest = [(w, r.c) for r in counts.collect() if v.rows.get(w := bytes(r.w), places) >= places]
    ids = v.look_up([w for w, _ in rest])[1]
    np.add.at(share, ids - places, [c + 1 for _, c in rest])
    assert np.array_equal(share, v.rest) and len(np.unique(ids)) == classes
    model, ids = v.model(), np.arange(places + classes)
    model.p["wc"] += np.random.Generator(np.random.PCG64(1)).normal(0, 1, model.p["wc"].shape)
    states = np.full((len(ids), gru_lm.HIDDEN + 1), 0.3, np.float32)
    states[:, -1] = 1
    want = np.exp(model.log_probs(states, ids)[0].astype(float))
    assert math.isclose(want.sum(), 1, rel_tol=1e-4)
    model.p["wc"][-1] += 90  # beyond what needs no shift
    assert np.allclose(np.exp(model.log_probs(states, ids)[0].astype(float)), want, rtol=1e-3)


def test_gru_gradients_and_state():
    model = gru_lm.Gru(np.arange(50, 0, -1.0), 10.0)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    r = np.random.Generator(np.random.PCG64(2))
    model.p["wo"] += r.normal(0, 0.1, model.p["wo"].shape)
    model.p["wc"] += r.normal(0, 0.1, model.p["wc"].shape)
    y = r.integers(0, 60, (3, 5))
    x = np.concatenate([np.full((3, 1), gru_lm.START), y[:, :-1]], axis=1)
    x[1, 3] = gru_lm.START  # a text begins
    h, live = np.zeros((3, gru_lm.HIDDEN)), np.ones((3, 5), bool)
    live[2, 3:] = False
    for mask in (None, live):
        _, _, g = model.window(h, x, y, mask)
        rows, sums = g["x"]
        g["x"] = np.zeros_like(model.p["x"])
        g["x"][rows] = sums
        for k in ("u", "x", "wc", "bu", "wo"):
            at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
            old, e = model.p[k][at], 1e-5
            model.p[k][at] = old + e
            up = model.window(h, x, y, mask)[1]
            model.p[k][at] = old - e
            down = model.window(h, x, y, mask)[1]
            model.p[k][at] = old
            assert math.isclose((up - down) / (2 * e), g[k][at], rel_tol=2e-3)
    texts = [r.integers(0, 60, n) for n in (1, 31, 100)]
    for t, s in zip(texts, model.score(texts), strict=True):
        assert math.isclose(s, -model.window(np.zeros((1, gru_lm.HIDDEN)), np.concatenate(([gru_lm.START], t[:-1]))[None], t[None])[1], rel_tol=1e-4)


def test_windows_do_no_more_than_their_tokens(monkeypatch):
    """The exponentials of a window: of all classes and the gates for each token, of the places of one class for known ones."""
    done = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, x, **more):
            done.append(x.size)
            return np.exp(x, **more)

    monkeypatch.setattr(gru_lm, "np", Counting())
    model = gru_lm.Gru(np.arange(900, 0, -1.0), 10.0)
    y = np.random.Generator(np.random.PCG64(3)).integers(0, 1025, (40, 32))
    x = np.concatenate([np.full((40, 1), gru_lm.START), y[:, :-1]], axis=1)
    model.window(np.zeros((40, gru_lm.HIDDEN), np.float32), x, y)
    known = int((y < 1024).sum())
    assert known < y.size and sum(done) == y.size * (33 + 2 * gru_lm.HIDDEN) + known * 32
    done.clear()
    texts = [t[:n].astype(np.int32) for t, n in zip(y, range(1, 33))]
    model.score(texts)
    assert sum(done) == sum(len(t) * (33 + 2 * gru_lm.HIDDEN) + int((t < 1024).sum()) * 32 for t in texts)


def test_weights_move_by_plain_steps():
    r = np.random.Generator(np.random.PCG64(4))
    got = [r.normal(0, 1, 2 * gru_lm.HELD + 5), *np.zeros((2, 2 * gru_lm.HELD + 5))]
    w, a, b = (x.copy() for x in got)
    for n in range(1, 5):
        grad, scale = r.normal(0, 50, len(w)), 1 / (10 * n)
        a, b = 0.9 * a + 0.1 * scale * grad, 0.99 * b + 0.01 * (scale * grad) ** 2
        w = w - 0.02 * (a / (1 - 0.9**n)) / (np.sqrt(b / (1 - 0.99**n)) + 1e-6)
        gru_lm.moved(got[0], grad, got[1], got[2], scale, n, 0.02)
        for x, y in zip(got, (w, a, b), strict=True):
            assert np.allclose(x, y, rtol=1e-9, atol=1e-12)


def test_words_are_split_and_looked_up_alike():
    r = random.Random(3)
    parts = [b" ", b"\t", b"\n", b"\v", b"\f", b"\r", b"A", b"z", b"Q", b"x", b"\0", b"\x1c", "\u00c4\u0130".encode(), "\u00a0\u0085".encode(), b"\xff"]
    texts = [b"", b" ", *(b"".join(r.choices(parts, k=r.randrange(12))) for _ in range(3000))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"]).slice(1)
    got, n = [], 0
    for part in gru_lm.pieces(batch, 0):
        words, ends = gru_lm.split_words(part.column(0))
        n += part.num_rows
        got += [words.slice(i, j - i).to_pylist() for i, j in zip([0, *ends.tolist()[:-1]], ends.tolist(), strict=True)]
    assert n == len(texts) - 1 and got == [t.lower().split() for t in texts[1:]]
    words = [w for t in texts for w in gru_lm.tokens(t)]
    assert gru_lm.ending_crcs(pa.array(words, pa.binary()).slice(2)).tolist() == [zlib.crc32(w[-3:]) for w in words[2:]]
    v = gru_lm.Vocabulary(Counter(words).most_common(1100), 32, {})
    rows, ids = v.look_up(words)
    assert rows.min() == -1 and rows.max() == 1099 and rows.tolist() == [v.rows.get(w, -1) for w in words]
    assert ids.tolist() == [i if 0 <= i < 1024 else 1024 + zlib.crc32(w[-3:]) % 32 for i, w in zip(rows.tolist(), words, strict=True)]


def test_pieces_hold_every_row(monkeypatch):
    monkeypatch.setattr(gru_lm, "PIECE", 10)
    texts = [b"", b"a" * 25, b"b" * 4, b"c" * 6, b"d", b"", b"e" * 11, b""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
    assert [p.column(0).to_pylist() for p in gru_lm.pieces(batch, 0)] == [texts[:1], texts[1:2], texts[2:4], texts[4:6], texts[6:7], texts[7:]]
    assert not list(gru_lm.pieces(batch.slice(0, 0), 0))


def test_counting_makes_no_object_of_a_word(spark, monkeypatch):
    """What Python itself holds while words are counted: less than the head of one bytes object for each."""
    monkeypatch.setattr(gru_lm, "COUNTED", 1 << 18, raising=False)
    training, words = MagicMock(), [f"W{i % 50_000}" for i in range(100_000)]
    gru_lm.count_tokens(training)
    run = training.select.return_value.mapInArrow.call_args[0][0]
    texts = [" ".join(words[i : i + 500]).encode() for i in range(0, len(words), 500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
    tracemalloc.start()
    out = list(run(iter([batch, batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = Counter()
    for b in out:
        for w, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
            found[w] += c
    assert found == {**{f"w{i}".encode(): 4 for i in range(50_000)}, gru_lm.END: 2 * len(texts)}
    assert peak < len(words) * sys.getsizeof(b"")


def test_scoring_looks_through_the_weights_once(monkeypatch):
    seen = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def abs(self, x):
            seen.append(x.size)
            return np.abs(x)

    monkeypatch.setattr(gru_lm, "np", Counting())
    model = gru_lm.Gru(np.arange(900, 0, -1.0), 10.0)
    texts = [np.arange(n, dtype=np.int32) % 1025 for n in (1, 40, 900)]
    model.score(texts)
    assert sorted(seen) == sorted([model.p["wc"].size, model.p["wo"].size])


def test_gradients_of_inputs_are_summed_by_id():
    r = np.random.Generator(np.random.PCG64(6))
    group, rows = r.choice([2, 3, 5, 11], (4, 6)), r.normal(0, 1, (4, 3, 6)).astype(np.float32)
    used, sums = gru_lm.sums_by(group, rows, 12)
    assert used.tolist() == sorted(set(group.ravel().tolist()))
    assert np.allclose(sums, [[rows[:, k][group == i].sum() for k in range(3)] for i in used], rtol=1e-5)


@pytest.mark.parametrize("name", list(SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(f"select {', '.join(got.columns)} from ({SQL[name]})").fetchall()
    fix = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)
    assert fix(map(tuple, got.collect())) == fix(want)


def run_stages(spark, docs, folder, monkeypatch):
    """Every stage over what the last one kept, against a brute-force version."""
    import corpus_pipeline

    fits, fit = [], toxic_crf.fit
    monkeypatch.setattr(toxic_crf, "fit", lambda *a: fits.append(fit(*a)) or fits[-1])
    library, kept = Tokenizer.from_file(public_tokenizers.path(trie_bpe.TOKENIZER)), docs
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in kept.select("doc_id", "text", "source").collect()]
        out = stage(spark, kept, folder).cache()
        if name != "bpe":
            assert out.columns == docs.columns
            after = sorted(map(str, (tuple(r) for r in out.select("doc_id", "text", "source").collect())))
        if name == "toxicity":
            assert after == sorted(str(r) for r in before if fits[0] is None or judged_by_hand(fits[0], r[1])[0] < 0.5)
        if name == "exact_dedup":
            best = {}
            for r in before:
                sha = (r[1] or "").encode().translate(None, grace_dedup.BLANKS)
                best[sha] = min(best.get(sha, ((1,),)), ((-len(r[1] or ""), r[0] is None, r[0] or 0), str((r[0], r[1]))), key=lambda x: x[0])
            assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(t for _, t in best.values())
        if name == "ngram_jaccard":
            comps = brute_components([r[:2] for r in before])
            groups = {c for d, n, c in comps if n}
            assert len(after) == len(groups) + sum(not n for _, n, _ in comps) and {d for d, _, c in comps if d == c} <= {str(r.doc_id) for r in out.collect()}
        if name == "mix_sources":
            want = Counter()
            for r, (_, size, _, _, taken) in zip(before, mix_by_hand(before), strict=True):
                want[str(r)] += taken // size if size else 1
            assert Counter(after) == +want
        if name == "bpe":
            digest = lambda t: (hashlib.sha256(",".join(map(str, ids := library.encode(t or "", add_special_tokens=False).ids)).encode()).hexdigest(), len(ids))
            assert sorted((str(r.doc_id), r.ids_sha256, r.n_tokens) for r in out.collect()) == sorted((str(d), *digest(t)) for d, t, _ in before)
        kept = out
    assert kept.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return kept


def test_pipeline(spark, monkeypatch):
    assert run_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, monkeypatch).count() > 0


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path, odd, empty, monkeypatch):
    import corpus_pipeline

    unique = odd.withColumn("doc_id", F.when(F.col("doc_id") != 2, F.col("doc_id")).otherwise(2 + F.coalesce(F.length("source"), F.lit(0))))
    run_stages(spark, unique, SF, monkeypatch)
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_decide_by_id_and_text(spark, monkeypatch, odd):
    import corpus_pipeline

    near, far = " ".join(f"n{i}" for i in range(80)), [" ".join(f"{c}{i}" for i in range(80)) for c in "abcd"]
    rows = [(1, near, "x"), (None, near + " end", "x"), (None, far[0], "x"), (2, near + " fin", "x"), (2, far[1], "x"), (3, far[2], "x"), (3, far[2] + " end", "x"), (None, far[3], "y"), (None, far[3] + " end", "y")]
    docs = spark.createDataFrame([(*r, "k", 0.5) for r in rows], DOCS)
    left = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    got = left(corpus_pipeline.ngram_jaccard(spark, docs, SF))
    assert len(got) == 5 and {(1, near), (None, far[0]), (2, far[1])} < set(got)
    assert [d for d, t in got if t.startswith(far[2])] == [3] and [d for d, t in got if t.startswith(far[3])] == [None]

    crf = toxic_crf.Crf(np.zeros(toxic_crf.FEATURES), -9.0, np.zeros((2, 2)), 0.0, np.array([1.0, 0.0, 0.0]))
    crf.weights[toxic_crf.slots("badword")[0]] = 30.0
    monkeypatch.setattr(toxic_crf, "fit", lambda *_: crf)
    bad = docs.unionByName(spark.createDataFrame([(None, "a badword", "x", "k", 0.5), (2, "badword b", "x", "k", 0.5)], DOCS))
    assert left(corpus_pipeline.toxicity(spark, bad, SF)) == left(docs)

    # one id, two texts: each stands as often as it is taken itself
    mixed = docs.unionByName(odd)
    times = Counter()
    for r in fair_mix.mix(mixed, key=corpus_pipeline._row_key("source")).collect():
        times[r.key] = max(times[r.key], r.taken // r.size if r.size else 1)
    keys = [r.k for r in mixed.select(corpus_pipeline._row_key("source").alias("k")).collect()]
    out = Counter(r.k for r in corpus_pipeline.mix_sources(spark, mixed, SF).select(corpus_pipeline._row_key("source").alias("k")).collect())
    assert out == Counter({k: n * times[k] for k, n in Counter(keys).items() if times[k]})
    assert corpus_pipeline.toxicity(spark, odd, SF).count() == 10


@pytest.mark.parametrize("name", ["copy_text_decode", "pgoutput_roundtrip", "stream_apply"])
def test_capture_queries_share_a_context(spark, name):
    """The operators and the queries on captures send their code in one file, in a context of their own."""
    run = """
import sys, duckdb
from pyspark.sql import SparkSession
from __spark_entry__ import oracle_sql, queries
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
name, sf = sys.argv[1:]
for q in ("op1_url_cascade", name, "op9_fair_mix", "op1_url_cascade"):
    got = queries()[q](spark, sf)
    rows = got.collect()
    for t in ("documents", "events", "pages"):
        duckdb.execute(f"create or replace view {t} as select * from '{sf}/{t}.parquet'")
    want = duckdb.execute(f"select {', '.join(got.columns)} from ({oracle_sql()[q]})").fetchall()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want)), q
assert spark.sparkContext._jsc.sc().listFiles().size() == 1
"""
    done = subprocess.run([sys.executable, "-c", run, name, SF], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
