"""Language, toxicity, quality, chat, fingerprints, mixing, packing, and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from helpers import SF, generalised_jaccard, shingle_classes, terms
from nestloom.llm import chat, language, mixing, packing, quality_trees, queries, toxicity, weighted_sampling
from pyspark.sql import functions as F


def held(i, m, r):
    return zlib.crc32(str(i).encode()) % m == r


def test_language_on_held_out_documents(spark, small):
    got = {r.doc_id: r for r in queries.op2_language_id(spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in small.collect()}
    out = [i for i in truth if held(i, 5, 0)]
    assert all(got[i].held_out == held(i, 5, 0) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in out) > 0.9 * len(out)


def test_language_of_odd_texts(docs):
    df = docs((1, None), (2, ""), (3, "123 !?"), (4, "der die das und nicht"), (4, "der die das und nicht"))
    found = language.classify(df, {"de": b"der die das und nicht ist", "en": b"the and of to in is"}).collect()
    assert [r.lang_pred for r in found] == ["und", "und", "und", "de", "de"]
    assert {r.lang_pred for r in language.classify(df, {}).collect()} == {"und"}
    assert language.fit_dictionaries(docs()) == {} and language.classify(docs(), {}).count() == 0


def plain_language_query(rows, texts=200, total=32_000):
    """Sample by id, letters, even pieces of whole texts, and the smallest compressed size, all without Spark."""
    import struct

    import xxhash
    import zstandard

    def chosen(i, n):
        h = xxhash.xxh64_intdigest(struct.pack("<i", 11), seed=xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42))
        return (h - (1 << 64) if h >> 63 else h) % 1_000_000 < min(1.0, texts / n) * 1_000_000

    def letters(text):
        return re.sub(" +", " ", re.sub(r"[^\w]|[\d_]", " ", text.lower())).strip()

    learn = [(i, t, lang) for i, t, lang in rows if t and lang and not held(i, 5, 0)]
    n = Counter(lang for *_, lang in learn)
    dictionaries = {}
    for lang in sorted(n, key=lambda x: (-n[x], x)):
        given = [x for x in (letters(t) for i, t, own in learn if own == lang and chosen(i, n[lang])) if x]
        sizes = [len(x.encode()) + 1 for x in given]
        share = max(c for c in range(total + 1) if sum(min(c, s) for s in sizes) <= total)
        dictionaries[lang] = "\n".join(sorted(language.spread(x, share - 1) for x in given)).encode()
    out = {}
    for i, text, _ in rows:
        data = letters(text or "").encode()
        sizes = {}
        for lang, d in dictionaries.items():
            learned = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=6, dict_data=learned, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(c.compress(data[k : k + 4096])) for k in range(0, len(data), 4096))
        out[i] = min(sizes, key=sizes.get) if data else "und"
    return dictionaries, out


def test_language_query_equals_plain_python(spark, small):
    rows = [(r.doc_id, r.text, r.lang) for r in small.collect()]
    _, wanted = plain_language_query(rows)
    got = {r.doc_id: r for r in queries.op2_language_id(spark, SF).collect()}
    assert {i: r.lang_pred for i, r in got.items()} == wanted
    learn = small.where(F.col("doc_id").isin([i for i, *_ in rows if not held(i, 5, 0)]))
    fewer, _ = plain_language_query(rows, texts=10, total=3000)
    for parts in (1, 7):
        assert language.fit_dictionaries(learn.repartition(parts), dictionary_bytes=3000, texts=10) == fewer


def test_language_dictionaries_hold_whole_texts(docs):
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}\u00e9" for i in range(17_000)) * 12  # over 1 MiB
    df = docs((1, long), (2, "kurz"), (None, "ohne nummer")).withColumns({"lang": F.lit("xx"), "letters": F.lit(1), "size": F.lit(2)})
    found = language.fit_dictionaries(df, dictionary_bytes=4000)["xx"]
    assert 3500 < len(found) <= 4000 and b"kurz" in found and found.decode()
    places = [long.index(w) / len(long) * 12 for w in found.decode().split() if w.startswith("w")]
    assert len(places) > 300 and np.std(places) > 0.2, "pieces come from everywhere"
    got = {r.doc_id: r.lang_pred for r in language.classify(df, {"yy": "zzz \u00fc".encode(), "xx": found}).collect()}
    assert got[1] == "xx" and len(got) == 3
    assert language.spread("\u00e9" * 500, 300, 100) and language.spread("ab", 300) == "ab" and language.level([5, 1, 9], 12) == 6


def naive_kernel(s, t):
    """All common subsequences of three characters, each with the decay of what it spans."""
    from itertools import combinations

    def spans(w):
        out = defaultdict(float)
        for p in combinations(range(len(w)), toxicity.ORDER):
            out["".join(w[i] for i in p)] += toxicity.DECAY ** (p[-1] - p[0] + 1)
        return out

    a, b = spans(s), spans(t)
    return sum(v * b[k] for k, v in a.items())


def test_subsequence_kernel_equals_its_definition():
    pairs = [("idiot", "i.d.iot"), ("idiot", "idiotic"), ("banana", "ananas"), ("abc", "xyz"), ("ab", "abc")]
    left, right = (toxicity._codes([p[k] for p in pairs]) for k in (0, 1))
    assert np.allclose(toxicity.subsequence_kernel(left, right), [naive_kernel(*p) for p in pairs], rtol=1e-4)


def test_toxicity_learns_words_and_tolerates_inserted_characters(spark, docs):
    rows = [(i, "what a lovely calm day " + ("you stupidhead" if i % 3 == 0 else "you neighbour")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(*rows), labels, F.col("doc_id") % 5 != 0)
    odd = docs((1, "such a st.upid*head"), (2, "stupidheads"), (3, "good neighbours"), (4, None), (5, "stu" * 5000 + " calm"), (6, ""))
    got = {r.doc_id: r.predicted for r in toxicity.score(odd, model).collect()}
    assert (got[1], got[2], got[3], got[4], got[6]) == (1, 1, 0, 0, 0) and got[5] in (0, 1)
    clash = odd.withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    assert toxicity.reject(clash, model).columns == clash.columns
    assert {r.doc_id for r in toxicity.reject(clash, model).collect()} == {i for i, p in got.items() if not p}


def test_separated_characters_keep_the_likeness_of_every_landmark(spark, docs):
    landmarks = ["idiot", "moron", "stupid", "scumbag", "loser"]
    features = toxicity.TextFeatures(landmarks)
    plain = features.of(landmarks)
    for sign in "*.- _\n":
        assert np.allclose(features.of([f"so, {sign.join(w)}!" for w in landmarks]), plain), repr(sign)
    assert np.allclose(features.of(["m-o-r-on", "id.i.ot", "sc.um.ba.g", "l, o, s, e, r"])[:, :5], plain[[1, 0, 3, 4], :5])
    assert np.allclose(features.of(["y o u s t u p i d m a n"])[0, 2], 1.0), "no ends are known"
    assert not features.of(["i a b c", "x - y - z", "1 2 3 4 5 6 7 8 9 10", "well-known and/or e.g. a", None, ""]).any()
    rows = [(i, "what a lovely calm day " + ("you stupid" if i % 3 == 0 else "you neighbour")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(*rows), labels, F.col("doc_id") % 5 != 0)
    odd = docs((1, "a s*t*u*p*i*d one"), (2, "a s t u p i d one"), (3, "a n e i g h b o u r"), (4, "good neighbours"))
    assert [r.predicted for r in toxicity.score(odd, model).orderBy("doc_id").collect()] == [1, 1, 0, 0]


def test_classifiers_without_labels_are_constant(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    df = docs((1, "a"), (None, None), (3, ""))
    for module in (toxicity, quality_trees):
        model = module.fit(df, none, F.lit(True))
        assert {round(r.score, 6) for r in module.score(df, model).collect()} == {0.5}
        assert module.score(docs(), model).count() == 0


def test_quality_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    out = [i for i in labels if held(i, 3, 1)]
    assert out and sum(got[i].predicted == labels[i] for i in out) > 0.9 * len(out)


def test_flat_trees_equal_walking_each_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality_trees.grow(x, y, trees=12, depth=3, least=1.0)
    walked = []
    for row in x:
        total = trees.start
        for t in range(len(trees.feature)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + (2 if row[trees.feature[t, node]] > trees.threshold[t, node] else 1)
            total += trees.value[t, node - trees.feature.shape[1]]
        walked.append(1 / (1 + np.exp(-total)))
    assert np.allclose(trees.scores(x), walked)
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.95


def test_chat_round_trip_and_expansion(spark):
    said = r"\### Assistant: </turn> ok"
    turns = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 2, "user", "b"), (1, 3, "assistant", "c\n"), (1, 4, "user", "d")]
    turns += [(2, 0, "user", None), (3, 0, "assistant", ""), (None, 0, "a:b<", "x"), (None, 0, "a:b<", "x")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    found = chat.examples(df).collect()
    one = [r for r in found if r.conv_id == 1]
    assert [len(chat.read_turns(r.text)) for r in one] == [2, 4, 5]
    assert [chat.unescape(r.text[r.loss_start : r.loss_end]) for r in one] == [said, "c\n", ""]
    assert chat.read_turns(one[-1].text) == [(r, t) for c, _, r, t in turns if c == 1]
    got = {r.conv_id: r for r in chat.digests(chat.examples(df)).collect()}
    assert got[1].loss_sha256 == hashlib.sha256((said + "c\n").encode()).hexdigest() and got[1].loss_chars == len(said) + 2
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for c, _, r, t in turns if c == 1).encode()).hexdigest()
    assert (got[2].n_turns, got[2].loss_chars, got[3].n_turns, got[None].n_turns) == (1, 0, 1, 2)
    assert chat.digests(chat.examples(df.limit(0))).count() == 0


def test_chat_query_reads_back_all_conversations(spark):
    want = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want[r.conv_id].append((r.role, r.text or ""))
    got = {r.conv_id: r for r in queries.op5_chat_formatting(spark, SF).collect()}
    assert set(got) == set(want) | {-7}
    for conv, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_fingerprints_estimate_generalised_jaccard(small):
    rows = sorted(((r.doc_id, r.text) for r in small.collect()), reverse=True)
    got = {r.doc_id: r for r in weighted_sampling.fingerprints(small).collect()}
    off = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [got[i].near_edited - generalised_jaccard(terms(text), terms(edited)), got[i].near_next - generalised_jaccard(terms(text), terms(after))]
    assert abs(np.mean(off)) < 0.02 and np.mean(np.abs(off)) < 0.06


def test_fingerprints_of_odd_tables(docs):
    df = docs((5, "a a b"), (5, "a a b"), (4, None), (3, ""), (2, "a a b"), (None, "x"))
    found = weighted_sampling.fingerprints(df.withColumns({"h": F.lit(1), "n": F.lit("n"), "copies": F.lit(9)}), samples=8).collect()
    got = {r.doc_id: r for r in found}
    assert sorted(r.doc_id or 0 for r in found) == [0, 2, 3, 4, 5, 5], "one result for each row"
    assert got[5].fingerprint == got[2].fingerprint and got[None].near_next == 0.0, "rows without id come last"
    assert got[2].edited_sha256 == hashlib.sha256(b"a ax").hexdigest(), "one half of the last document, which is one sign"
    assert got[None].edited_sha256 == hashlib.sha256(b"x").hexdigest()
    assert (got[4].near_next, got[4].near_edited, got[5].near_next) == (1.0, 1.0, 0.0)
    assert weighted_sampling.fingerprints(docs((1, "lone text"))).first().near_next == 1.0
    assert weighted_sampling.fingerprints(docs()).count() == 0


def test_fingerprints_of_several_texts_under_one_id(docs):
    df = docs((7, "one two three four"), (7, "five six"), (None, "seven eight"), (None, "nine"), (None, "nine"), (8, "one two three four"))
    found = weighted_sampling.fingerprints(df, samples=16).collect()
    assert Counter((r.doc_id, r.n_chars) for r in found) == {(7, 18): 1, (7, 8): 1, (None, 11): 1, (None, 4): 2, (8, 18): 1}
    by = defaultdict(set)
    for r in found:
        by[r.n_chars].add(r.fingerprint)
    assert len(by[18]) == 1 and len({f for v in by.values() for f in v}) == 4


def test_raking_matches_the_margins(spark):
    cells = [("a", "x", "p", 100), ("a", "y", "q", 300), ("b", "x", "q", 50), ("b", "y", "p", 550)]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic string, tokens bigint")
    goals = {m: spark.createDataFrame(v, f"_{m} string, target double") for m, v in
             {"source": [("a", 0.5), ("b", 0.5)], "lang": [("x", 0.3), ("y", 0.7)], "topic": [("p", 0.6), ("q", 0.4)]}.items()}
    got = mixing.rake(df, goals, rounds=30, close=1e-6).collect()
    for m, want in (("_source", {"a": 0.5, "b": 0.5}), ("_lang", {"x": 0.3, "y": 0.7}), ("_topic", {"p": 0.6, "q": 0.4})):
        sums = Counter()
        for r in got:
            sums[r[m]] += r["weight"]
        assert all(abs(sums[k] - v) < 1e-3 for k, v in want.items())


def test_mixing_keeps_rows_and_decides_by_probability(docs, small):
    df = docs((1, "a b"), (1, "a b"), (2, None), (None, "c")).withColumn("lang", F.lit(None).cast("string")).withColumn("tokens", F.lit(1))
    got = mixing.mix(df).collect()
    assert len(got) == 4 and all(0 < r.mix_probability <= 1 for r in got)
    assert len({r.mix_kept for r in got if r.doc_id == 1}) == 1
    assert mixing.mix(docs()).count() == 0
    mixed = mixing.mix(small).agg(F.sum(F.col("mix_kept").cast("int")), F.sum("mix_probability")).first()
    assert abs(mixed[0] - mixed[1]) < 4 * np.sqrt(mixed[1])


def raked(sizes, shares, wanted, rounds):
    """Weights by plain numpy: goals levelled by what there is, then steps over the three margins."""
    free, most, goals = sizes / sizes.sum(), sizes / wanted, []
    axes = [tuple(j for j in range(3) if j != k) for k in range(3)]
    for k in range(3):
        there, growth = most.sum(axes[k]), 1.0
        for _ in range(20):
            full = shares[k] * growth >= there
            growth = max(growth, (1 - there[full].sum()) / shares[k][~full].sum())
        goals.append(np.minimum(there, shares[k] * growth))
    for _ in range(rounds):
        for k in range(3):
            w = np.minimum(free, most).sum(axes[k])
            full = np.where(free >= most * (1 - 1e-9), most, 0).sum(axes[k])
            step = [(g - f) / (x - f) if x - f > 1e-9 * x and g - f > 1e-9 * g else 1 if x - f <= 1e-9 * x and g - f >= -1e-9 * g else g / x
                    for x, f, g in zip(w, full, goals[k], strict=True)]
            free = free * np.expand_dims(step, axes[k])
    return np.minimum(free, most)


@pytest.mark.parametrize("seed", [1, 2])
def test_raking_equals_plain_numpy(spark, seed):
    sizes = np.random.default_rng(seed).integers(10, 1000, (3, 3, 3))
    shares = [np.array(x) for x in ([0.5, 0.3, 0.2], [0.2, 0.2, 0.6], [0.4, 0.35, 0.25])]
    cells = [(*map(str, at), int(n)) for at, n in np.ndenumerate(sizes)]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic string, tokens bigint")
    goals = {m: spark.createDataFrame([(str(i), float(v)) for i, v in enumerate(x)], f"_{m} string, target double") for m, x in zip(mixing.MARGINS, shares, strict=True)}
    want = raked(sizes, shares, sizes.sum() / 2, 2)
    for r in mixing.rake(df, goals, rounds=2, close=None, wanted_tokens=float(sizes.sum() / 2)).collect():
        assert abs(r.weight - want[int(r._source), int(r._lang), int(r._topic)]) < 1e-9


def test_mixing_keeps_the_columns_of_the_caller(docs):
    df = docs((1, "a b"), (2, "c" * 2_000_000), (3, ""))
    for name in ("_source", "_lang", "_topic", "_tokens", "_row", "_chance", "tokens", "weight", "a b.c"):
        df = df.withColumn(name, F.lit("own"))
    got = mixing.mix(df.withColumn("mix_probability", F.lit("own"))).collect()
    assert {r.doc_id: r.mix_tokens for r in got} == {1: 3, 2: 2_000_000, 3: 1}
    assert all(r[c] == "own" for r in got for c in ("_source", "_lang", "_topic", "_tokens", "_row", "_chance", "tokens", "weight", "a b.c"))
    assert all(isinstance(r.mix_probability, float) for r in got), "an added column replaces one of its name"


def test_mixing_with_given_topics_tokens_and_targets(spark, docs):
    df = docs(*[(i, f"text {i}") for i in range(400)]).withColumn("topic", F.when(F.col("doc_id") < 100, "t").otherwise("u"))
    goal = {"topic": spark.createDataFrame([("t", 0.5), ("u", 0.5)], "_topic string, target double")}
    got = mixing.mix(df, goal, topics=F.col("topic"), tokens=F.lit(10), wanted_tokens=1000, rounds=6, close=None).collect()
    sums = Counter()
    for r in got:
        assert r.mix_tokens == 10 and r.mix_topic == r.topic
        sums[r.topic] += r.mix_probability * r.mix_tokens
    assert abs(sums["t"] - 500) < 1 and abs(sums["u"] - 500) < 1


def test_mixing_keeps_rare_values_whole_and_the_rest_as_before(spark, docs):
    hot = [(i, f"common words {i} " * 20) for i in range(600)]
    source = F.when(F.col("doc_id") < 300, "hot").otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")))
    df = docs(*hot).withColumn("source", source).withColumn("lang", F.when(F.col("doc_id") % 4 == 0, "de").otherwise("en"))
    rare = docs((9999, "two words")).withColumn("source", F.lit("rare")).withColumn("lang", F.lit("own"))
    before, after = ([r for r in mixing.mix(d).collect()] for d in (df, df.union(rare)))
    share = [sum(r.mix_probability * r.mix_tokens for r in rows) / sum(r.mix_tokens for r in rows) for rows in (before, after)]
    assert all(abs(s - mixing.KEEP) < 0.01 for s in share)
    assert [r.mix_probability for r in after if r.doc_id == 9999] == [pytest.approx(1.0, abs=0.01)]
    was = {r.doc_id: r.mix_probability for r in before}
    assert all(abs(r.mix_probability - was[r.doc_id]) < 0.01 for r in after if r.doc_id in was)
    assert all(abs(r[f"mix_gap_{m}"]) < 0.02 for r in after if r.doc_id != 9999 for m in mixing.MARGINS)
    assert all(r.mix_gap_source < -0.3 for r in after if r.doc_id == 9999), "what a value lacks of its target is returned"


def test_mixing_to_a_wanted_total_and_contradicting_targets(spark):
    cells = [("a", "x", "p", 1000), ("a", "y", "q", 3000), ("b", "x", "q", 900), ("b", "y", "p", 5500), ("c", "z", "p", 40)]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic string, tokens bigint")
    goals = {m: spark.createDataFrame(v, f"_{m} string, target double") for m, v in
             {"source": [("a", 0.4), ("b", 0.5), ("c", 0.1)], "lang": [("x", 0.3), ("y", 0.6), ("z", 0.1)], "topic": [("p", 0.6), ("q", 0.4)]}.items()}
    got = mixing.rake(df, goals, wanted_tokens=4000).collect()
    tokens = {r._source + r._lang: r.weight * 4000 for r in got}
    assert abs(sum(tokens.values()) - 4000) < 8 and abs(tokens["cz"] - 40) < 1, "all there is of c"
    assert all(r.weight * 4000 <= r.tokens * (1 + 1e-9) for r in got)
    assert abs(tokens["ax"] + tokens["ay"] - 3960 * 4 / 9) < 8 and abs(tokens["ax"] + tokens["bx"] - 3960 / 3) < 8
    goals["lang"] = spark.createDataFrame([("x", 0.5), ("y", 0.495), ("z", 0.005)], "_lang string, target double")
    with pytest.warns(UserWarning, match="contradict"):
        odd = mixing.rake(df, goals, wanted_tokens=4000).collect()
    assert max(abs(r.gap_source) + abs(r.gap_lang) for r in odd) > 0.05


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_word_tokenizer_equals_the_tokenizer_file(small):
    import public_tokenizers

    odd = ["", " ", "  a", "a  b", "a\n b", "a \n\n b ", "don't it's", "x<|endoftext|>y <|endoftext|>", "é ü\t\tq", "a b  c", "1234 5,6.7!!", "end "]
    texts = odd + [r.text for r in small.collect()]
    own = packing.WordTokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(own.ids(t), "<u4").tolist() for t in texts] == want


def check_sequences(rows, capacity):
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.length))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(ends)


def test_packing_is_gapless_and_tight(spark, small):
    got = packing.pack(packing.token_pieces(small)).collect()
    rows = small.collect()
    tokens = {r.doc_id: e.ids + [0] for r, e in zip(rows, tokenizer().encode_batch([r.text for r in rows], add_special_tokens=False), strict=True)}
    for r in got:
        ids = tokens[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(map(len, tokens.values()))
    assert check_sequences(got, 2048) <= -(-sum(map(len, tokens.values())) // 2048) + 1


@pytest.mark.parametrize("sizes", [[6] * 50, [1], [], [3, 7, 5, 5, 10, 2, 8] * 20, [10] * 5])
def test_packing_in_rounds(spark, sizes):
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, length bigint")
    got = packing.pack(df, capacity=10, per_task=15).collect()
    assert len(got) == len(sizes)
    least = {50: 50, 1: 1, 0: 0, 140: 80, 5: 5}[len(sizes)]
    assert check_sequences(got, 10) <= least + len(sizes) // 15


def test_pieces_of_odd_texts(docs):
    got = packing.token_pieces(docs((1, None), (2, ""), (3, "word " * 3000), (None, "a"))).collect()
    assert [(r.start, r.length) for r in got if r.doc_id in (1, 2)] == [(0, 1)] * 2
    long_one = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 3)
    assert [p[2] for p in long_one[1:]] == [2048] * (len(long_one) - 1) and long_one[0][2] <= 2048


def test_pipeline_stages_against_brute_force(spark, small):
    kept, stages = small, dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    clean = stages["toxicity"](spark, kept, SF).cache()
    assert clean.columns == small.columns and clean.count() > 0.6 * small.count()
    exact = stages["exact_dedup"](spark, clean, SF).cache()
    first = {}
    for r in clean.orderBy("doc_id").collect():
        first.setdefault("".join(c.lower() if c.isascii() else c for c in r.text), r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(first.values())
    near = stages["near_dedup"](spark, exact, SF).cache()
    want = shingle_classes([(r.doc_id, r.text) for r in exact.collect()], 5, 80)
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, c in want.values()})
    mixed = stages["mixing"](spark, near, SF).cache()
    assert mixed.columns == small.columns and mixed.subtract(near).count() == 0
    packed = stages["packing"](spark, mixed, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed.collect()}
    check_sequences(packed, 2048)


def test_pipeline_stages_on_odd_rows(spark, docs):
    df = docs((1, None), (1, None), (2, ""), (None, "a b c d e f g"), (None, "a b c d e f g"), (5, "A b c d e f g"), (6, "x " * 5000))
    df = df.withColumn("kept", F.lit("k")).withColumn("row", F.lit(1)).withColumn("_norm", F.lit(2))
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
        if name == "exact_dedup":
            assert sorted(r.doc_id for r in df.collect()) == [1, 5, 6]
        if name != "packing":
            assert df.columns[-3:] == ["kept", "row", "_norm"]
    empty = docs()
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
