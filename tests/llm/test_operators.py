"""Every operator against its plain restatement on awkward rows: nulls, blanks, very long texts, copies, repeated rows, clashing columns."""

import collections
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moorspark.llm import decontaminate, language, lex, licence, packing, pii, quality, repeats, shard, simhash, tokenfile, tokens
from moorspark.session import materialize, scratch_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard string, fp string, uid string, slot string, base string, score string, "
          "spans string, lines string, seq string, grp string, contaminated string, component_id string")
PASSAGE = "Upon the quiet harbour seven grey gulls argued about bread while Old Boats slept in rows"
ITEMS = [(1, PASSAGE), (2, "two words"), (3, None), (4, ""), (None, "seven grey gulls argued about bread while old boats slept today"), (7, "zz " * 12), (8, "--- ...")]
EN = "the of and to in that was his with for it had not are but from have they which one you were all her she there would their"
DE = "der die und das nicht ist ein eine auch sich mit dem auf für wird sind bei nach über zwischen größer möglich können würde"


def _texts():
    rng = np.random.default_rng(7)
    def prose(words, n):
        w = rng.choice(words.split(), n)
        return " ".join(w[:n // 2]) + ".\n" + " ".join(w[n // 2:]).capitalize() + "."
    out = [None, "", " ", "\n\n \t", "...!!!", "a", "Ab c", "é", "ß x", "  wide　blank  double   triple", "12345 678 .. 90", "<|endoftext|> x <|startoftext|>",
           "it's   we'll  \n  'tis \n \n b", " lead", "trail ", "\r\nwin\r\n lines\x0b\x0c", "x\x00y z", "👍🏽 ok 👍", "Á Å Å", "a@b.c_d@e.f", "mail a.b+c@x-y.org, me@localhost",
           "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.0255.1.1", "4111 1111 1111 1111 and 4111111111111112", "+1 (212) 555-0100 +1 23 +12345678901234567890", "call +49 30 1234567 now. 4012-8888-8888-1881",
           "9" * 3000, "a" * 3000 + "@", "+1((((((((", 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7c0aa"', "MIT License. Apache\nLicense; GNU General Public License v3", "Licensed under CC BY-NC 4.0. mit mit license",
           PASSAGE + ".", "zz " * 40, "two  WORDS", "Two-words two, words", "so " + PASSAGE.upper() + " end", "b" * 70, "b" * 49, "b" * 50, "ab" * 60]
    base = [prose(EN, 60) for _ in range(6)] + [prose(DE, 60) for _ in range(6)]
    out += base + base[:3] + [b + " more words here" for b in base[:4]] + [base[0].replace("the", "The", 1), base[1][:150] + "X" + base[1][150:]]
    out += ["one very long line " + prose(EN, 30000), ("common footer line of this host\n" if True else "") + prose(EN, 30)]
    out += [f"common footer line of this host\n{prose(EN, 40)}" for _ in range(25)] + ["common footer line of this host\nCOMMON  footer line of this host\nshort " + "common footer line of this host " * 3] * 2
    out += [" ".join(EN.split()[:9]) + " " + " ".join(EN.split()[:9]) + " " + prose(EN, 20)]
    return out


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    out = [(i, t, "de" if t and "ü" in t else "en", "h" if i % 7 else None, 0, *["clash"] * 12) for i, t in enumerate(texts)]
    return out + [out[40], out[40], out[3]] + [(40, "another text under the id forty", None, "h", None, *[None] * 12)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return materialize(spark.createDataFrame(rows, SCHEMA).repartition(3), "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    return collections.Counter(tuple(r) for r in df.select(*cols).collect())


def expect(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_repeats(spark, docs, rows, empty):
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = brute.repeats([(r[0], r[1]) for r in rows])
    assert got(repeats.clean(docs), *cols) == expect(want)
    assert sum(r[2] for r in want) > 1000
    assert repeats.clean(empty).count() == 0
    null = spark.createDataFrame([(None, "q" * 60), (None, "q" * 60), (5, "q" * 60)], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_removed) for r in repeats.clean(null).collect()) == [(False, 10 * 0), (True, 60), (True, 60)]


def test_repeats_by_brute_force_over_small_alphabets(spark):
    rng = np.random.default_rng(3)
    unit = ["".join(rng.choice(list("abc"), 80)) for _ in range(4)]
    texts = ["".join(u[rng.integers(0, 40): rng.integers(41, 80)] for u in rng.choice(unit, 4)) + "é" * int(rng.integers(0, 30)) for _ in range(60)]
    pairs = list(zip(rng.permutation(60).tolist(), texts))
    out = repeats.clean(spark.createDataFrame(pairs, "doc_id long, text string").repartition(7))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expect(brute.repeats(pairs))


def test_suffix_array_and_common_prefixes():
    t = np.random.default_rng(1).integers(97, 99, 400).astype(np.uint8)
    sa = repeats.suffix_array(t)
    raw = t.tobytes() + b"\0" * 60
    keys = [raw[i: i + 50] for i in sa]
    assert keys == sorted(keys)
    lcp = repeats.common_prefixes(t, sa)
    for i in range(1, 400):
        a, b = t[sa[i]:][:50].tobytes(), t[sa[i - 1]:][:50].tobytes()
        k = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
        assert lcp[i] == k or (lcp[i] > k and k == min(len(a), len(b)) and lcp[i] < 50)


def test_shards(spark, docs, rows, empty):
    root = shard.tree()
    out = shard.assign(docs, root, shard.grow(root, 16)).toPandas()
    assert sorted(zip(out.doc_id, out["size"], out.text_crc32)) == sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert ((out.grown_shard == out["shard"]) | (out.grown_shard == 16)).all()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert (out.groupby("doc_id")["shard"].nunique() == 1).all()
    assert shard.assign(empty, root).count() == 0


def test_shard_weights_move_rows_only_in_their_subtrees(spark):
    ids = spark.range(40000)
    before = shard.tree()
    after = shard.tree(weights={5: 3.0})
    both = ids.select(shard.place(F.col("id"), before).alias("a"), shard.place(F.col("id"), after).alias("b"), shard.place(F.col("id"), shard.grow(before, 16)).alias("g")).toPandas()
    assert np.allclose(both.groupby("a").size(), 2500, rtol=0.1)
    moved = both[both.a != both.b]
    # shard 5 sits in rack 1 of region 0: whoever moves between other regions or racks does not exist
    assert ((moved.b // 8 == 0) & ((moved.a // 8 != 0) | (moved.b // 4 == 1))).all()
    assert np.isclose((both.g == 16).mean(), 1 / 17, rtol=0.1)


def test_packing(docs, rows, empty):
    out = packing.pack_documents(docs).toPandas()
    coder = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = []
    for r in rows:
        ids = coder.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want += [(r[0], i // 2048, i, len(ids[i: i + 2048]), brute.crc_ids(ids[i: i + 2048])) for i in range(0, len(ids), 2048)]
    assert expect(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)) == expect(want)
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.offset == out.groupby("sequence_id").length.cumsum() - out.length).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 2048) + 1
    assert packing.pack_documents(empty).count() == 0


def test_genetic_steps_keep_solutions_valid():
    rng = np.random.default_rng(5)
    length = rng.integers(1, 2000, 300)
    people = packing.seed(length, rng, 2048)
    for _ in range(20):
        i, j = rng.choice(len(people), 2, replace=False)
        child = packing.crossover(length, people[i], people[j], rng, 2048)
        assert len(child) == 300 and child.min() >= 0 and np.bincount(child, length).max() <= 2048
    first = packing.fitness(length, people[0], 2048)
    assert packing.fitness(length, packing.evolve(length, people, rng, 2048)[0], 2048) >= first


def test_packing_over_many_groups(spark):
    cut = materialize(spark.range(3000).select(F.col("id").alias("uid"), (F.pmod(F.xxhash64("id"), F.lit(2048)) + 1).alias("length")), "cut")
    out = packing.pack(cut, 2048, group=200).toPandas()
    assert len(out) == 3000 and out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() <= 1.03 * out.length.sum() / 2048


def test_licences(docs, rows, empty):
    out = licence.scan(docs)
    assert got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == expect((r[0], *brute.licences(r[1])) for r in rows)
    frame = out.toPandas()
    assert frame.score.between(0, 1).all() and (frame[frame.labels != ""].score > 0).all()
    assert "cc-by-nc" in set(",".join(frame.labels).split(","))
    assert licence.scan(empty).count() == 0


def test_licence_text_needs_its_key_phrase(spark):
    text = licence.TEMPLATES["mit-text"].replace("[", "").replace("]", "")
    out = {r.doc_id: r for r in licence.scan(spark.createDataFrame([(1, "x y " + text.upper() + " z"), (2, text.replace("granted free", "granted not free"))], "doc_id long, text string")).collect()}
    assert out[1].labels == "mit-text" and out[1].score == 1.0 and out[2].labels == ""


def test_token_files(spark, docs, rows, empty):
    def run(df):
        path = public_tokenizers.path(tokenfile.TOKENIZER)
        ids = materialize(tokens.encoded(df, path, 2), "ids")
        out = scratch_path(spark, "tokens")
        tokenfile.write(spark, ids, out, tokens.coder(path).tokenizer.get_vocab_size())
        return tokenfile.read(spark, out)

    coder = Tokenizer.from_file(public_tokenizers.path(tokenfile.TOKENIZER))
    out = run(docs).toPandas().sort_values("start")
    want = [(r[0], (x := coder.encode(r[1] or "", add_special_tokens=False).ids + [2]), len(x), brute.crc_ids(x)) for r in rows]
    assert expect(out[["doc_id", "n_tokens", "ids_crc32"]].itertuples(index=False)) == expect((d, n, c) for d, _, n, c in want)
    assert out.doc_id.is_monotonic_increasing and (out.start == out.n_tokens.cumsum() - out.n_tokens).all()
    assert run(empty).count() == 0


def test_token_files_with_counts_of_the_encoding(spark, docs, rows, empty):
    """Counts taken while encoding rank the ids as counting them afterwards does, and the files hold the same documents."""
    path = public_tokenizers.path(tokenfile.TOKENIZER)
    size = tokens.coder(path).tokenizer.get_vocab_size()

    def run(df):
        ids = materialize(tokenfile.counted(df, path, 2, size), "ids")
        out = scratch_path(spark, "tokens")
        tokenfile.write(spark, ids, out, size)
        return ids, tokenfile.read(spark, out)

    coder = Tokenizer.from_file(path)
    ids, got = run(docs)
    out = got.toPandas().sort_values("start")
    want = [(r[0], (x := coder.encode(r[1] or "", add_special_tokens=False).ids + [2]), len(x), brute.crc_ids(x)) for r in rows]
    assert expect(out[["doc_id", "n_tokens", "ids_crc32"]].itertuples(index=False)) == expect((d, n, c) for d, _, n, c in want)
    assert out.doc_id.is_monotonic_increasing and (out.start == out.n_tokens.cumsum() - out.n_tokens).all()
    times = np.bincount(np.concatenate([w[1] for w in want]), minlength=size)
    assert tokenfile.rank_table(ids, size).tolist() == np.argsort(np.lexsort((np.arange(size), -times))).tolist()
    assert tokenfile.rank_table(ids.where("seen IS NULL").drop("seen"), size).tolist() == tokenfile.rank_table(ids, size).tolist()
    assert run(empty)[1].count() == 0


def test_blocks_hold_whole_documents():
    sizes = [4, 6, 1, 25, 10, 1, 9, 9]
    off = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.arange(off[-1]) % 50
    cut = [(0, 3), (3, 3), (3, 6), (6, 8)]
    got = list(tokenfile.in_blocks(((list(range(a, b)), ids[off[a]: off[b]], off[a: b + 1] - off[a]) for a, b in cut), 10))
    assert [(d, c.tolist()) for d, c, _ in got] == [([0, 1], [4, 6]), ([2], [1]), ([3], [25]), ([4], [10]), ([5, 6], [1, 9]), ([7], [9])]
    assert np.concatenate([x for _, _, x in got]).tolist() == ids.tolist()


def test_variable_length_coding_round_trip():
    v = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    for n in range(len(v) + 1):
        back, used = tokenfile.unpack(tokenfile.pack(v[:n]), n)
        assert back.tolist() == v[:n].tolist() and used == len(tokenfile.pack(v[:n]))
    ids, n, ranks = tokenfile.decode_block(tokenfile.encode_block([None, 5, 5], np.array([2, 0, 7]), v))
    assert (ids, n.tolist(), ranks.tolist()) == ([None, 5, 5], [2, 0, 7], v.tolist())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoding_equals_the_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 40)
    own, plain = tokens.Coder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    rng = np.random.default_rng(2)
    pool = list("aB'stz19.,!<|é漢İªº²«×Š") + [" ", " ", " ", "\n", "\t", " ", "\x1c", "́", "'s", "ll "]
    plain_pool = list("aBstz19.,!|éŠ«×ß  \n")
    texts = ["".join(rng.choice(p, int(n))) for p in (pool, plain_pool) for n in rng.integers(0, 60, 400)] + [t or "" for t in _texts()]
    texts += [" ".join("".join(rng.choice(list("abÄé19.,|«"), int(n))) for n in rng.integers(1, 9, 12)).replace("b a", "b\na") for _ in range(300)]
    for a in range(0, len(texts), 37):
        ids, off = own.encode(*lex.text_buffers(pa.array(texts[a: a + 37])), 7)
        for t, x, y in zip(texts[a: a + 37], off[:-1], off[1:]):
            assert ids[x:y].tolist() == plain.encode(t, add_special_tokens=False).ids + [7], repr(t)


def test_simhash(docs, rows, empty):
    prints = [(r[0], brute.fingerprint(r[1])) for r in rows]
    want = [(d, f if f < 2**63 else f - 2**64, c) for (d, f), (_, c) in zip(prints, brute.components(prints))]
    for dense in (simhash.DENSE, 1):
        assert got(simhash.near_duplicates(docs, dense), "doc_id", "fp", "component_id") == expect(want)
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_links_of_both_ways(spark):
    rng = np.random.default_rng(11)
    centre = rng.integers(-(2**63), 2**63 - 1, 12)
    fps = []
    for c in centre.tolist():
        x = c
        for _ in range(12):
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False).tolist():
                x ^= 1 << b if b < 63 else -(2**63)
            fps.append(x)
    prints = list(enumerate(fps))
    want = expect(brute.components([(d, f % 2**64) for d, f in prints]))
    table = materialize(spark.createDataFrame(prints, "doc_id long, fp long"), "prints")
    for dense in (1, 3, 1000):
        assert got(simhash.group(table, dense), "doc_id", "component_id") == want


def test_quality(docs, rows, empty):
    out = quality.judge(docs).toPandas()
    cols = ["doc_id", *quality.COUNTS, "base_failed"]
    assert expect(out[cols].itertuples(index=False)) == expect((r[0], *brute.quality(r[1])) for r in rows)
    assert not out[out.base_failed].kept.any()
    footer = [r[0] for r in rows if (r[1] or "").startswith("common footer") and r[3] == "h"]
    lost = out[out.n_boilerplate_chars > 0]
    assert set(lost.doc_id) == set(footer) and len(footer) > 20
    assert quality.judge(empty).count() == 0


def test_quality_rejects_depleted_documents(spark):
    line = "same words in every page of this host again and again with enough words to pass twenty words in all cases here"
    out = quality.judge(spark.createDataFrame([(i, line + (f"\nown{i}" if i else "\n" + " ".join(f"w{j}" for j in range(60))), "h") for i in range(30)], "doc_id long, text string, source string")).toPandas()
    assert out[out.kept].doc_id.tolist() == [0] and (out.n_boilerplate_chars == len(line.replace(" ", ""))).all()


def test_personal_data(docs, rows, empty):
    model = pii.fit(docs)
    out = pii.all_spans(docs.select("doc_id", "text"), model, "text", "base", "found").select("doc_id", "text", pii._joined("base").alias("b"), pii._joined("found").alias("s"), pii.redacted(F.col("text"), F.col("found")).alias("r")).collect()
    assert expect((r.doc_id, r.b) for r in out) == expect((r[0], brute.personal(r[1])[5]) for r in rows)
    for r in out:
        assert set(r.b.split(",")) <= set(r.s.split(",")) if r.b else True
        want, at = "", 0
        for x in filter(None, r.s.split(",")):
            k, a, b = x.split(":")
            if int(a) >= at:
                want += r.text[at:int(a)] + f"[{k.upper()}]"
            at = max(at, int(b))
        assert r.r == (want + r.text[at:] if r.text is not None else None)
    assert pii.all_spans(empty, pii.fit(empty), "text", "_b", "_s").count() == 0


def test_trees_learn_the_format_of_secrets(spark):
    rng = np.random.default_rng(4)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(60)]
    texts = [f'words here token = "{h}" and more' for h in hexes[:50]] + [f"see {h} there" for h in hexes[50:51]] + [f"identifier_number_{i}_of_a_long_name" for i in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pii.all_spans(d, pii.fit(d), "text", "base", "found").select("doc_id", pii._joined("found").alias("s")).collect()
    by = {r.doc_id: r.s for r in out}
    assert all(by[i] == f"secret:20:60" for i in range(50)) and not any(by[i] for i in range(51, 111))


def test_decontamination(spark, docs, rows, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute.leaks([(r[0], r[1]) for r in rows], [("" if i is None else i, t) for i, t in ITEMS])
    out = decontaminate.scan(docs, items, ["doc_id", "text"], prefix="_")
    assert got(out, "doc_id", *[f"_{c}" for c in cols[1:]]) == expect(want) and sum(r[5] for r in want) == 5
    for r in out.collect():
        left = [t for t in brute.leaks([(0, decontaminate.cut(r.text, r._spans))], [(2, "two words"), (1, PASSAGE)])]
        assert left[0][2] == 0
    assert decontaminate.scan(empty, items, ["doc_id"]).count() == 0
    assert not decontaminate.scan(docs, items.limit(0), ["doc_id"]).where("contaminated").count()


def test_decontamination_in_several_blocks(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = got(decontaminate.scan(docs, items, ["doc_id"]), "doc_id", "n_hit", "items_sha256")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    assert len(decontaminate.phrase_blocks(spark, items)) > 2
    assert got(decontaminate.scan(docs, items, ["doc_id"]), "doc_id", "n_hit", "items_sha256") == one


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(9)
    s = rng.integers(1, 5, 500)
    index = decontaminate.FMIndex(s, 5)
    for k in (1, 2, 3, 5):
        phrases = np.array([s[i: i + k] for i in rng.integers(0, 490, 30)] + [[4] * k])
        lo, hi = index.search(phrases, np.full(len(phrases), k))
        for p, a, b in zip(phrases, lo, hi):
            want = [i for i in range(500 - k + 1) if (s[i: i + k] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == want


def test_language(docs, rows, empty):
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    out = language.identify(docs.select("doc_id", "text"), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")), r.text
    assert language.identify(empty.select("text"), language.fit(empty)).count() == 0


def test_language_on_the_held_out_fold(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice((EN if i % 2 else DE).split(), 30)), "en" if i % 2 else "de") for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify(d, language.fit(d)).collect()
    held = [r for r in out if language.held_out(r.doc_id)]
    assert len(held) > 50 and all(r.lang == r.lang_pred for r in held)


def test_language_learns_nothing_from_the_held_out_fold(spark):
    d = spark.createDataFrame([(i, "zz qq", "x") if language.held_out(i) else (i, "the of and", "en") for i in range(60)], "doc_id long, text string, lang string")
    assert language.fit(d).languages == ["en"]


def test_grams_do_not_cross_documents():
    buf, off = lex.text_buffers(pa.array(["ab", "", None, "cd e", "f"]))
    g, ptr = language.grams(buf, off)
    assert [int(x).to_bytes(4, "little") for x in g] == [b" ab ", b" cd "] and ptr.tolist() == [0, 1, 1, 1, 2, 2]


def test_blocks_keep_documents_whole():
    texts = ["x" * n for n in (5, 0, 30, 2, 2, 2, 9)] + [None]
    parts = list(lex.blocks(pa.record_batch([pa.array(texts)], ["text"]), limit=8))
    assert [t for rows, _, _ in parts for t in rows.column("text").to_pylist()] == texts
    assert all(len(buf) <= 8 or rows.num_rows == 1 for rows, buf, _ in parts)
