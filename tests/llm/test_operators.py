"""Each operator against a brute-force version, an exact round trip, or held-out accuracy."""

import glob
import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from prodseries.llm import (
    decontamination,
    language_id,
    line_chunks,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_arrays,
    token_files,
    tokens,
)
from prodseries.llm.queries import QUERIES
from prodseries.llm.statements import STATEMENTS
from prodseries.llm.text_stats import RATIOS
from pyspark.sql import functions as F
from tests.llm.odd import LONG, ROWS, labels, no_documents, odd_documents

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts(spark):
    return dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statement(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    mine = QUERIES[name](spark, SF)
    theirs = con.execute(f"SELECT {', '.join(mine.columns)} FROM ({STATEMENTS[name]})").fetchall()
    assert sorted(map(tuple, mine.collect())) == sorted(theirs)


# 1: suffix arrays


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 700):
        data = bytes(rng.choice([97, 98], n).astype(np.uint8)) * 2
        buf = np.frombuffer(data, np.uint8)
        order, rank = suffix_arrays.suffix_array(buf, len(buf) + 1)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        found = suffix_arrays.common_prefixes(buf, order, rank, 50)
        for k in range(1, len(data)):
            assert found[k] == min(50, len(os.path.commonprefix([data[order[k - 1] :], data[order[k] :]])))


def removals(found):
    return {(r["doc_id"], r["kept_sha256"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in found.collect()}


def expected_removals(texts):
    data = {d: (t or "").encode() for d, t in texts.items()}
    gone = substring_dedup.removed_by_brute_force(data)
    return {
        (d, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone[d]].tobytes()).hexdigest(), len(t), int(gone[d].sum()),
         int((np.diff(np.concatenate(([0], gone[d].astype(int)))) == 1).sum()))
        for d, t in data.items()
    }


@pytest.mark.parametrize("hot", [substring_dedup.HOT_DOCUMENTS, 2])
def test_substrings_against_brute_force(docs, texts, hot):
    found = substring_dedup.without_repeats(docs, shard_bytes=20_000, hot_documents=hot)
    assert removals(found) == expected_removals(texts)


def test_substrings_of_odd_documents(spark):
    found = substring_dedup.without_repeats(odd_documents(spark))
    assert found.count() == len(ROWS)
    rows = {(r["doc_id"], r["kept"]): r for r in found.collect()}
    assert rows[(None, ROWS[12][1].encode())]["n_removed"] == 0
    assert rows[(11, ROWS[14][1].encode())]["n_removed"] == 0
    assert rows[(4, LONG.encode())]["n_removed"] == 0
    assert [r["n_removed"] for r in found.filter("doc_id = 8").collect()] == [len(LONG)] * 2
    assert substring_dedup.without_repeats(no_documents(spark)).count() == 0


# 2 and 4: tokens


def expected_ids(text):
    library = tokens.encoder(TOKENIZER).library
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_encoder_equals_the_library():
    rng = np.random.default_rng(2)
    parts = [*"abzABZ09.,!'_-<|>\t\n \x0b\x1c\x1f\x00éßÑ×÷’ŸİΣſ日😀", "\xa0", "́", "<|endoftext|>", " 's", "don't"]
    some = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(3000)] + [None, ""]
    ids, counts = tokens.encoder(TOKENIZER).encode(some)
    for text, part in zip(some, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert part.tolist() == expected_ids(text).tolist()[:-1], text


def memo_bytes(made):
    return sum(v.nbytes for v in vars(made).values() if isinstance(v, np.ndarray))


def test_memo_of_many_pieces_is_small():
    made = tokens.Encoder(TOKENIZER)
    assert memo_bytes(made) < 10 << 20
    words = ["".join("abcdefghij"[int(d)] for d in f"{i:05d}") for i in range(100_000)]
    some = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    ids, counts = made.encode(some)
    assert made.count == len(words) and memo_bytes(made) < 16 << 20
    again = made.encode(some)
    assert np.array_equal(ids, again[0]) and np.array_equal(counts, again[1])
    for i in (0, 77, 199):
        assert ids[counts[:i].sum() : counts[: i + 1].sum()].tolist() == expected_ids(some[i]).tolist()[:-1]


def test_memo_of_long_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_IDS", 20_000, raising=False)
    made, rng = tokens.Encoder(TOKENIZER), np.random.default_rng(3)
    for _ in range(30):
        text = "".join(map(chr, rng.integers(0x4E00, 0x9000, 3000)))
        assert made.encode([text])[0].tolist() == expected_ids(text).tolist()[:-1]
        assert made.used <= 20_000 + 3 * 3000 and len(made.pool) <= 1 << 16


def test_packing_drops_the_encoder_before_it_cuts(spark, monkeypatch):
    def stop():
        raise ValueError("the encoder goes here")

    tokens.encoder(TOKENIZER)
    monkeypatch.setattr(tokens, "_ENCODERS", dict(tokens._ENCODERS))
    tokens.released()
    assert not tokens._ENCODERS
    monkeypatch.setattr(packing, "released", stop)
    with pytest.raises(Exception, match="the encoder goes here"):
        packing.packed(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), TOKENIZER).collect()


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(pieces, expected, width):
    """Every id in one piece, sequences gapless, padding only where the width is not reached."""
    sequences, said = {}, Counter()
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert sequences.get(r["sequence_id"], 0) == r["offset"]
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
        said[(r["doc_id"], r["doc_tokens"], r["start"], bytes(r["ids"]))] += 1
    whole = Counter()
    for (doc, n, start, ids), k in said.items():
        whole[(doc, n)] += k * (len(ids) // 4)
    assert whole == sum((Counter({(d, len(i)): len(i)}) for d, i in expected), Counter())
    by_doc = {}
    for doc, ids in expected:
        by_doc.setdefault((doc, len(ids)), set()).add(ids.tobytes())
    for doc, n, start, ids in said:
        assert any(whole_ids[4 * start : 4 * start + len(ids)] == ids for whole_ids in by_doc[(doc, n)])
    sizes = list(sequences.values())
    assert max(sizes, default=0) <= width and sorted(sequences) == list(range(len(sizes)))
    assert all(n == width or n & (n - 1) == 0 for n in sizes)


def test_packing_round_trip(docs, texts):
    pieces = packing.packed(docs, TOKENIZER, 256).collect()
    check_pieces(pieces, [(d, expected_ids(t)) for d, t in texts.items()], 256)


def test_packing_of_odd_documents(spark):
    pieces = packing.packed(odd_documents(spark), TOKENIZER, 2048).collect()
    check_pieces(pieces, [(d, expected_ids(t)) for d, t in ROWS], 2048)
    assert packing.packed(no_documents(spark), TOKENIZER).count() == 0


@pytest.mark.parametrize("ids", [[], [5], [7] * 3000, [0, 49407] * 700, list(range(2000)), [1, 2, 3] * 400 + [2**32 - 1], [2**32 - 1, 0]])
def test_blocks_round_trip(ids):
    ids = np.array(ids, dtype=np.uint32)
    data = token_files.written_segment(ids, np.array([len(ids)]), block=512)
    assert token_files.read_segment(data)[0].tolist() == ids.tolist()
    for first, count in ((0, 1), (3, 700), (511, 2), (1024, 5000)):
        assert token_files.read_segment(data, first, count)[0].tolist() == ids[first : first + count].tolist()


def test_blocks_patch_outliers():
    ids = np.array([*range(100), 4_000_000], dtype=np.uint32)
    assert len(token_files.packed_block(ids)) < 110


def test_token_files(spark, docs, texts, tmp_path):
    token_files.write_token_files(docs, str(tmp_path / "t"), TOKENIZER)
    at, rows = 0, token_files.read_token_files(spark, str(tmp_path / "t")).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == sorted(texts)
    for r in rows:
        ids = expected_ids(texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) == (at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        at += len(ids)


def test_token_files_of_odd_documents(spark, tmp_path):
    token_files.write_token_files(odd_documents(spark), str(tmp_path / "t"), TOKENIZER)
    rows = token_files.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d))
    assert Counter(bytes(r["ids"]) for r in rows) == Counter(expected_ids(t).tobytes() for _, t in ROWS)
    token_files.write_token_files(no_documents(spark), str(tmp_path / "e"), TOKENIZER)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


# 3: decontamination


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contamination_of_odd_documents(spark):
    bench = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "tie tie tie"), (2, "tie tie tie"), (3, None), (4, " ,. "), (None, "été")]
    found = decontamination.contamination(odd_documents(spark), items(spark, bench))
    rows = {(r["doc_id"], r["n_words"]): r for r in found.collect()}
    assert found.count() == len(ROWS)
    assert rows[(5, 14)]["n_hit"] == 12 and rows[(5, 14)]["item_ids"] == ["1"]
    assert rows[(9, 10)]["n_hit"] == 10 and rows[(9, 10)]["item_ids"] == ["2"]
    assert rows[(2, 0)]["n_hit"] == 0 and not rows[(3, 0)]["contaminated"]
    assert rows[(8, 180_000)]["n_hit"] == 0
    # Only A-Z are folded.
    assert not any(r["contaminated"] for (d, _), r in rows.items() if d == 7)
    assert decontamination.decontaminated(odd_documents(spark), items(spark, bench)).count() == len(ROWS) - 3
    assert decontamination.contamination(no_documents(spark), items(spark, bench)).count() == 0
    assert not any(r["contaminated"] for r in decontamination.contamination(odd_documents(spark), items(spark, [])).collect())


def test_contamination_without_a_broadcast(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    with_it = sorted(map(str, decontamination.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", -1)
    monkeypatch.setattr("prodseries.llm.common.BROADCAST_BYTES", -1)
    assert sorted(map(str, decontamination.contamination(docs, bench).collect())) == with_it


def test_contamination_is_native(spark, docs):
    found = decontamination.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "alpha" + " x" * 40 + " beta gamma")], "doc_id long, text string")
    found = decontamination.proximity_matches(docs, items(spark, [(9, "alpha beta gamma")]), slop=5)
    assert {r["doc_id"] for r in found.collect()} == {1, 2}


def near_by_brute_force(texts, bench, slop, width=10):
    """(doc_id, item_id, start) by the rarest word of each window, in plain loops."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    said = {d: words(t) for d, t in texts.items()}
    times = Counter(w for ws in said.values() for w in ws)
    found = set()
    for item, text in bench:
        ws = words(text)
        for i in range(max(1, len(ws) - width + 1)) if ws else ():
            window = ws[i : i + width]
            rarest = min(range(len(window)), key=lambda j: (times[window[j]], j))
            for d, doc in said.items():
                for p in (p for p, w in enumerate(doc) if w == window[rarest]):
                    start = p - rarest
                    if all(w in doc[max(0, start + j - slop) : max(0, start + j + slop + 1)] for j, w in enumerate(window)):
                        found.add((d, item, start))
    return found


@pytest.mark.parametrize("slop", [0, 1, 4])
def test_proximity_against_brute_force(spark, slop):
    rng = np.random.default_rng(slop)
    vocabulary = [f"w{i}" for i in range(30)]
    bench = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 16)))) for i in range(25)] + [(99, None), (98, "")]
    texts = {}
    for d in range(60):
        own = bench[rng.integers(25)][1].split()
        at = rng.integers(0, len(own))
        own[at : at + 1] = [own[at], *rng.choice(vocabulary, rng.integers(0, 3))]
        if rng.random() < 0.4:
            rng.shuffle(own)
        texts[d] = " ".join([*rng.choice(vocabulary, rng.integers(0, 20)), *own, *rng.choice(vocabulary, rng.integers(0, 20))])
    texts |= {100: None, 101: "", 102: bench[0][1].upper()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = decontamination.proximity_matches(docs, items(spark, bench), slop=slop)
    assert set(map(tuple, found.collect())) == near_by_brute_force(texts, bench, slop)
    assert found.count() > 20
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())


def test_proximity_wants_every_term(spark):
    docs = spark.createDataFrame([(1, "unrelated zebra text with quokka inside of it"), (2, "quokka zebra a b c d e f g h")], "doc_id long, text string")
    found = decontamination.proximity_matches(docs, items(spark, [(1, "zebra quokka a b c d e f g h")]), slop=5)
    assert {r["doc_id"] for r in found.collect()} == {2}


def test_rows_without_ids_and_ids_of_several_texts_are_searched_one_by_one(spark):
    said = "one two three four five six seven eight nine ten"
    rows = [(None, f"x {said} y"), (None, "clean"), (None, None), (4, said), (4, "clean words here"), (5, said), (5, said)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.contamination(docs, items(spark, [(1, said)])).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in found), key=str) == sorted(
        [(None, 12, 10, True), (None, 1, 0, False), (None, 0, 0, False), (4, 10, 10, True), (4, 3, 0, False), (5, 10, 10, True), (5, 10, 10, True)], key=str
    )


def test_the_index_holds_each_word_of_the_test_set_once(spark, docs, texts):
    windows, _ = decontamination.test_windows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    terms = decontamination.test_terms(windows)
    base = docs.select(F.col("doc_id").alias("row"), "text")
    index = decontamination.training_postings(base, terms).join(terms, "term").select("row", "pos", "word").collect()
    known = {r["word"] for r in terms.collect()}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    assert sorted(map(tuple, index)) == sorted((d, p, w) for d, t in texts.items() for p, w in enumerate(words(t)) if w in known)


# 5: language


def test_language_held_out(docs):
    found = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_documents(spark):
    rows = language_id.languages(odd_documents(spark)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r["doc_id"] in (2, 3, 6, 12):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language_id.languages(no_documents(spark)).count() == 0


def test_training_texts_are_different(spark):
    rows = [(i, "the one text that has many copies", "en") for i in range(3000)]
    rows += [(5000 + i, f"another english text number {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}", "en") for i in range(90)]
    rows += [(6000 + i, f"un texte francais {'abcdefghij'[i]}", "fr") for i in range(10)] + [(7000, "null language", None), (7001, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = [(r["lang"], r["text"]) for r in language_id.training_rows(docs, 40).collect()]
    assert len(found) == len(set(found))
    assert Counter(lang for lang, _ in found)["en"] == 40 and 1 <= Counter(lang for lang, _ in found)["fr"] <= 10


def test_kernel_is_exact_on_texts_with_many_signs():
    rng = np.random.default_rng(1)
    one, two = ("".join(map(chr, rng.integers(0x4E00 + a, 0x4E00 + a + 9000, 60_000))) for a in (0, 9500))
    a, b = language_id.grams(one), language_id.grams(two)
    exact = {bytes(x) for k in (1, 2, 3) for x in zip(*[one.encode()[j:] for j in range(k)], strict=False)}
    assert len(a) >= len(exact) and len(a) > 20_000
    vocabulary = np.union1d(a, b)
    kernel = language_id.presence([a, b], vocabulary) @ language_id.presence([a, b], vocabulary).T
    assert kernel[0, 0] == pytest.approx(1, abs=1e-4)
    assert kernel[0, 1] == pytest.approx(len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)), abs=1e-4)
    model = language_id.fit_languages([language_id.grams(t[i : i + 400]) for t in (one, two) for i in range(0, 20_000, 400)], ["x"] * 50 + ["y"] * 50)
    assert model.predict([one, two])[0] == ["x", "y"]


# 6: quality rules


def counts_by_brute_force(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(grams)
    inside = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)
    )


def test_rule_counts(spark, docs, texts):
    found = quality_rules.rule_verdicts(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    for r in found:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts_by_brute_force(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
    odd = quality_rules.rule_verdicts(odd_documents(spark), labels(spark, [(0, 1, 0), (0, None, None), (None, 1, 1), (5, 0, None)]))
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_repeat_words"]) for r in odd.collect()) == Counter(
        (d, c[0], c[1], c[4]) for d, t in ROWS for c in [counts_by_brute_force(t)]
    )
    assert quality_rules.rule_verdicts(no_documents(spark), labels(spark)).count() == 0


def walked(trees, x):
    """The score of one row by walking each tree from its root to a leaf."""
    total = trees.base
    for root in trees.roots.tolist():
        node = root
        while trees.left[node] != node:
            node = int(trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node])
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def test_flattened_trees_score_like_a_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, len(RATIOS)))
    y = ((x[:, 0] + x[:, 3] * x[:, 4] > 0) ^ (rng.random(1500) < 0.1)).astype(float)
    trees = quality_rules.fit_trees(x, y, np.array([quality_rules.MONOTONE.get(r, 0) for r in RATIOS]))
    rows = np.concatenate([rng.normal(size=(200, len(RATIOS))), x[:50], np.zeros((1, len(RATIOS))), np.full((1, len(RATIOS)), 1e9)])
    assert np.allclose(trees.scores(rows), [walked(trees, r) for r in rows])


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(RATIOS)))
    y = ((x[:, 2] < 0.5) & (x[:, 1] > 0.2) ^ (rng.random(3000) < 0.05)).astype(float)
    monotone = np.array([quality_rules.MONOTONE.get(r, 0) for r in RATIOS])
    trees = quality_rules.fit_trees(x, y, monotone)
    assert ((trees.scores(x) > 0.5) == (y > 0.5)).mean() > 0.9
    row = np.repeat(rng.random((50, len(RATIOS))), 21, axis=0)
    row[:, 2] = np.tile(np.linspace(0, 1, 21), 50)
    assert (np.diff(trees.scores(row).reshape(50, 21), axis=1) <= 1e-12).all()


# 7: quality classifier


def test_classifier_tells_good_from_bad(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    given = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    # Labels of odd ids are held out.
    found = quality_classifier.posteriors(big, given.filter("doc_id % 2 = 0"), F.col("source"), F.col("lang"))
    rows = found.join(given.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] and not r["toxic"]]
    bad = [r["kept"] for r in rows if not r["quality"]]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_sparse_sites_shrink(spark):
    rows = [("big", "a", 2.0)] * 300 + [("bad", "b", -2.0)] * 300 + [("bad", "rare", 2.0)] + [("new", None, -2.0)]
    scored = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, host string, path string, evidence double")
    sites, rate = quality_classifier.site_posteriors(scored)
    prior = {(r["host"], r["path"]): r["prior"] for r in sites.collect()}
    assert prior[("bad", "b")] < rate < prior[("big", "a")]
    assert abs(prior[("bad", "rare")] - prior[("bad", "b")]) < 0.2
    assert abs(prior[("new", None)] - rate) < 0.2


def test_classifier_on_odd_documents(spark):
    for given in (labels(spark), labels(spark, [(0, 1, 0), (1, 0, 0), (1, 0, 0), (None, 1, 1), (4, None, None)])):
        found = quality_classifier.posteriors(odd_documents(spark), given, F.col("source"), F.col("lang")).collect()
        assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    assert quality_classifier.kept_documents(odd_documents(spark), labels(spark), F.col("source"), F.col("lang")).count() == len(ROWS)
    assert quality_classifier.posteriors(no_documents(spark), labels(spark), F.col("source"), F.col("lang")).count() == 0


def sites_by_brute_force(rows):
    """(host, path) -> posterior rate, in plain loops over (host, path, evidence)."""
    p = [(h, q, 1 / (1 + np.exp(-e))) for h, q, e in rows]
    rate = np.mean([x for _, _, x in p])

    def strength(groups, means):
        ss = sum(len(g) * (np.mean(g) - m) ** 2 for g, m in zip(groups, means, strict=True))
        chance = sum(np.mean(g) * (1 - np.mean(g)) for g in groups)
        spread = max(0.0, (ss - chance) / sum(map(len, groups)))
        return max(quality_classifier.LEAST_STRENGTH, rate * (1 - rate) / spread - 1) if spread else np.inf

    def shrunk(g, prior, k):
        return prior if np.isinf(k) else (sum(g) + k * prior) / (len(g) + k)

    hosts, paths = {}, {}
    for h, q, x in p:
        hosts.setdefault(h, []).append(x)
        paths.setdefault((h, q), []).append(x)
    k = strength(list(hosts.values()), [rate] * len(hosts))
    host_rate = {h: shrunk(g, rate, k) for h, g in hosts.items()}
    k2 = strength(list(paths.values()), [host_rate[h] for h, _ in paths])
    return {key: shrunk(g, host_rate[key[0]], k2) for key, g in paths.items()}, rate


def test_sites_against_brute_force_and_what_they_do(spark):
    """Dense good and bad hosts, a bad path in a good host, and sparse sites."""
    rng = np.random.default_rng(12)
    rows = [("good", "a", e) for e in rng.normal(3, 1, 400)] + [("good", "bad", e) for e in rng.normal(-3, 1, 150)]
    rows += [("bad", "b", e) for e in rng.normal(-4, 1, 500)] + [("sparse", "c", -4.0), (None, None, 2.0)]
    rows += [(f"host{i}", f"p{i % 3}", e) for i in range(40) for e in rng.normal(2, 1, 5)]
    scored = spark.createDataFrame([(i, *r) for i, r in enumerate((h, q, float(e)) for h, q, e in rows)], "doc_id long, host string, path string, evidence double")
    sites, rate = quality_classifier.site_posteriors(scored)
    expected, whole = sites_by_brute_force(rows)
    found = {(r["host"], r["path"]): r["prior"] for r in sites.collect()}
    assert rate == pytest.approx(whole)
    assert found.keys() == expected.keys()
    for key, want in expected.items():
        assert found[key] == pytest.approx(want, rel=1e-6, abs=1e-9)
    # A dense bad site counts for what it is, however far from the rest; a sparse one says less.
    assert found["bad", "b"] < 0.1 < found["sparse", "c"] and found["good", "bad"] < 0.4 < found["good", "a"]


def test_dense_sites_pull_without_a_bound(spark, monkeypatch):
    def evidence(rows, model):
        return rows.select("doc_id", "host", "path", F.when(F.col("text") == "bad", -5.0).when(F.col("text") == "unsure", 0.5).otherwise(5.0).alias("evidence"))

    monkeypatch.setattr(quality_classifier, "with_evidence", evidence)
    rows = [("bad", "badhost")] * 300 + [("good", "goodhost")] * 900 + [("unsure", "badhost"), ("unsure", "goodhost")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, host string")
    found = quality_classifier.posteriors(docs, labels(spark), F.col("host"), F.col("host")).filter("evidence = 0.5").collect()
    assert {r["host"]: r["kept"] for r in found} == {"badhost": False, "goodhost": True}
    pull = {r["host"]: np.log(r["score"] / (1 - r["score"])) - 0.5 for r in found}
    assert pull["badhost"] < -3 and pull["goodhost"] > 1


# 8: near duplicates


def groups_by_brute_force(texts, k, percent):
    sets = {}
    for d, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(d for d in texts if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            met = len(sets[a] & sets[b])
            if 100 * met >= percent * (len(sets[a]) + len(sets[b]) - met):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in texts}


def test_groups_that_only_blocks_join(spark, monkeypatch):
    """A chain whose links are not all with a bucket's smallest document, dealt in blocks."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    rng = np.random.default_rng(4)
    texts = {}
    for g in range(6):
        words = [f"w{g}x{i}" for i in range(120)]
        for k in range(12):
            texts[100 * g + k] = " ".join(words)
            at = rng.integers(0, 120)
            words = [*words[:at], f"n{g}x{k}", *words[at + 1 :]] if k % 3 else words[6:] + [f"m{g}x{k}y{i}" for i in range(6)]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(docs, 4, 80).collect()}
    assert found == groups_by_brute_force(texts, 4, 80)


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    for share in (0.0, 0.5, 0.8, 1.0):
        n = int(share * len(a))
        b = np.unique(np.concatenate((a[:n], rng.integers(0, 1 << 63, len(a) - n).astype(np.uint64))))
        row = [near_duplicates.packed_low_bits(near_duplicates.minima(s)).view(np.int64).tolist() for s in (a, b)]
        frame = spark.createDataFrame([tuple(row)], "a array<long>, b array<long>")
        got = frame.select(near_duplicates.estimate(F.col("a"), F.col("b"))).first()[0]
        assert abs(got - n / (2 * len(a) - n)) < 0.2


def test_low_bits_collide_by_function():
    rng = np.random.default_rng(7)
    sets = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    bits = np.stack([near_duplicates.packed_low_bits(near_duplicates.minima(s)) for s in sets.reshape(-1, 1)])
    x = bits[::2] ^ bits[1::2]
    lanes = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
    assert abs(lanes.mean() - 120) < 1 and 5 < lanes.std() < 6


def test_links_of_four_and_five_shingles(spark):
    """Texts of 7 and 8 words, at a similarity of exactly 0.8."""
    rng = np.random.default_rng(8)
    texts = {}
    for p, words in enumerate(rng.integers(0, 1 << 40, (30_000, 8)).tolist()):
        long = " ".join(map(str, words))
        texts[2 * p], texts[2 * p + 1] = long, long.rsplit(" ", 1)[0]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_duplicates.near_duplicates(docs, 4, 80)
    assert found.filter("component_id <> doc_id - doc_id % 2").count() == 0


def test_near_duplicates_of_odd_documents(spark):
    found = near_duplicates.near_duplicates(odd_documents(spark), 5, 80)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["doc_id"], []).append((r["n_shingles"] > 0, r["component_id"], r["kept"]))
    assert rows[8] == [(True, 4, False)] * 2 and rows[4] == [(True, 4, True)]
    assert rows[9] == [(True, 9, True)] and rows[10] == [(True, 9, False)]
    assert rows[2] == rows[3] == rows[6] == [(False, None, True)] or (rows[2], rows[3]) == ([(False, 2, True)], [(False, 3, True)])
    assert sorted(rows[None], key=str) == sorted([(True, 11, False), (False, None, True)], key=str)
    kept = near_duplicates.one_of_each(odd_documents(spark), 5, 80)
    assert kept.columns == odd_documents(spark).columns
    assert near_duplicates.near_duplicates(no_documents(spark)).count() == 0


@pytest.mark.parametrize(("sizes", "rows"), [((19_000, 700, 300), 19_000 + 1000 * 11), ((20_000, 0, 0), 20_000), ((3, 2, 1), 9)])
def test_buckets_with_one_large_group_are_dealt_in_proportion(spark, sizes, rows):
    members = [(1, i, g, 50, [0], [0]) for g, n in enumerate(sizes) for i in range(g * 100_000, g * 100_000 + n)]
    frame = spark.createDataFrame(members, "key long, doc_id long, root long, n_shingles long, bits array<long>, bands array<long>")
    dealt = near_duplicates.dealt_in_blocks(frame)
    assert dealt.count() <= max(rows, len(members) + 3)
    # Every two members of different groups meet in one task group.
    if len(members) < 10:
        met = Counter()
        for r in dealt.groupBy("p", "q").agg(F.collect_list(F.struct("doc_id", "root", "own")).alias("m")).collect():
            for a in r["m"]:
                for b in r["m"]:
                    if a.root < b.root and {a.own, b.own} == {r["p"], r["q"]}:
                        met[a.doc_id, b.doc_id] += 1
        assert set(met.values()) == {1} and len(met) == 3 * 2 + 3 * 1 + 2 * 1


def test_blocks_are_bounded_in_shingles(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", 1000)
    members = [(1, i, 0 if i < 100 else 1, 100, [0], [0]) for i in range(200)]
    frame = spark.createDataFrame(members, "key long, doc_id long, root long, n_shingles long, bits array<long>, bands array<long>")
    most = near_duplicates.dealt_in_blocks(frame).groupBy("p", "q").agg(F.sum("n_shingles").alias("n")).agg(F.max("n")).first()[0]
    assert most < 6000


# 9: sharding


def check_shards(found, n_rows, n_shards):
    rows = found.collect()
    assert len(rows) == n_rows
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert 0 <= r["shard"] < n_shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_shards_are_even(docs):
    rows = check_shards(sharding.assign_shards(docs, 6), 200, 6)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


def test_a_third_of_rows_with_one_text(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    rows = check_shards(sharding.assign_shards(docs, 24), 30_000, 24)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) <= 1.02 * min(sizes.values())


def test_shards_of_odd_documents(spark, tmp_path):
    check_shards(sharding.assign_shards(odd_documents(spark), 24), len(ROWS), 24)
    assert sharding.assign_shards(no_documents(spark)).count() == 0
    sharding.write_shards(odd_documents(spark), str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(ROWS)


# 10: line chunks


def test_chunks_against_brute_force(spark, docs, texts):
    data = {**texts, **{1000 + d: f"own start {d}\n{t}\nown end" for d, t in list(texts.items())[:80] if t}}
    frame = spark.createDataFrame(list(data.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(frame).collect()}
    expected = line_chunks.removed_by_brute_force(data)
    assert found == expected
    assert sum(found[d] != data[d] for d in data) > 40


def test_boundaries_resist_shifts():
    rng = np.random.default_rng(6)
    lines = [f"line {rng.integers(1 << 40)}" for _ in range(60)]
    a = set(map(tuple, line_chunks.chunk_lines("\n".join(lines).encode())[2].tolist()))
    b = set(map(tuple, line_chunks.chunk_lines("\n".join(["new", "lines", *lines]).encode())[2].tolist()))
    assert len(a & b) >= len(a) - 3


def test_chunks_of_odd_documents(spark):
    docs = odd_documents(spark)
    found = line_chunks.without_repeats(docs)
    assert sorted(found.columns) == sorted(docs.columns) and found.count() == len(ROWS)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[0]["text"] == ROWS[0][1] and rows[2]["text"] is None and rows[3]["text"] == ""
    assert 0 < rows[1]["n_removed"] <= 14 and len(rows[1]["text"]) < len(ROWS[1][1])
    assert line_chunks.without_repeats(no_documents(spark)).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 8, 20, 200])
def test_whole_runs_of_lines_go(spark, n):
    """Passages of any length from two lines on, by what stands around them alone."""
    texts, expected = {}, {}
    for p in range(12):
        passage = [f"passage {p} of {n} line {i}" for i in range(n)]
        texts[p] = "\n".join([f"own start {p}", *passage, f"own end {p}"])
        texts[100 + p] = "\n".join([f"other start {p}", *passage, f"other end {p}"])
        expected |= {p: texts[p], 100 + p: f"other start {p}\nother end {p}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(docs).collect()} == expected


def test_runs_with_empty_and_equal_lines(spark):
    rng = np.random.default_rng(9)
    texts = {d: "\n".join(rng.choice(["", "", "a", "b", "cc"], rng.integers(1, 12)).tolist()) for d in range(60)}
    texts |= {-5: "x\nx\nx\nx\nx", -4: "y\n\n\n\nz", -3: "\n\ny\n\n\nw", -2: "v\n\n\n\nz\n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(docs).collect()}
    assert found == line_chunks.removed_by_brute_force(texts)
    assert found[-5] == "x\nx" and found[-3] == "\n\nw" and found[-2] == "v\n"
