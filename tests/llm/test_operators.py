import hashlib
import html as entities
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from soundgrid.llm import base, chat, embeddings, html, langid, media, minhash, mixing, packing, queries, subword, tokens, warc

ODD = [(1, None, None), (2, "", "en"), (3, " \t\n", None), (4, "x", "en"), (5, "x", "en"), (5, "x", "en"), (6, "ab " * 40_000, "fr"), (7, "ü—😀 ß", "de"), (8, "12 34", None), (None, "no id", "en")]
KINDS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns, one of them with a name that operators use themselves
    return spark.createDataFrame(ODD, KINDS).withColumns({"source": F.lit("s"), "n_chars": F.lit(0), "score": F.lit("clash"), "component_id": F.lit(9), "n": F.lit(1)}).repartition(3).cache()


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


# media


def test_media_round_trip(spark, docs):
    rows = media.media_features(docs).toPandas()
    want = sorted((t or "").encode() for _, t, _ in ODD)
    assert sorted(rows.n_bytes) == sorted(map(len, want)) and all(rows.payload_bytes % 64 == 0) and rows.payload_bytes.min() == 64
    padded = Counter(hashlib.sha256(media.pad(w)).hexdigest() for w in want)
    assert Counter(rows.payload_sha256) == padded
    assert set(rows.tail_crc32) == {zlib.crc32(media.pad(w)[-64:]) for w in want}
    same = rows[rows.n_bytes == 1]
    assert same.feature.nunique() == same.media_sha256.nunique() == 1 and len(same) == 3
    assert media.media_features(docs.limit(0)).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.binary(max_size=2000))
def test_wav_is_lossless(data):
    assert media.wav_payload(media.wav_bytes(media.pad(data)))[: len(data)] == data


def test_peaks_do_not_depend_on_blocks(monkeypatch):
    data = np.random.default_rng(1).integers(32, 122, 40_000, dtype=np.uint8).tobytes()
    whole = media.peaks(data)
    monkeypatch.setattr(media, "BLOCK", 37)
    parts = media.peaks(data)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True)) and len(whole[0]) > 100
    tone = (128 + 100 * np.sin(np.arange(4096) * 2 * np.pi * 20 / 256)).astype(np.uint8).tobytes()
    assert 20 in set(media.peaks(tone)[1].tolist())


def brute_peaks(payload):
    """Peaks by loops: spectra by the definition of the transform, the strongest local maxima of each frame."""
    x = np.frombuffer(payload, np.uint8).astype(np.float64) - 128
    n = 1 + max(0, -(-(len(x) - 256) // 128))
    x = np.concatenate([x, np.zeros(256 + 128 * n)])
    wave = np.exp(-2j * np.pi * np.outer(np.arange(129), np.arange(256)) / 256)
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(256) / 255)
    m = [np.abs(wave @ (x[128 * k : 128 * k + 256] * hann)) for k in range(n)]
    out = []
    for k in range(n):
        own = []
        for f in range(1, 128):
            beside = [m[j][f] for j in (k - 1, k + 1) if 0 <= j < n]
            if m[k][f] > m[k][f - 1] and m[k][f] >= m[k][f + 1] and all(m[k][f] >= y for y in beside):
                own.append((m[k][f], f))
        out += [(k, f) for f in sorted(f for _, f in sorted(own)[-2:])]
    return out


def test_fingerprints_match_brute_force(spark):
    rng = random.Random(3)
    texts = {k: " ".join(rng.choice(["the", "über", "42", "sonar", "deep"]) for _ in range(rng.randrange(40, 300))) for k in range(6)}
    got = media.media_features(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for r in got:
        found = brute_peaks(media.pad(texts[r["doc_id"]].encode()))
        made = sorted((t, f << 20 | g << 8 | u - t) for k, (t, f) in enumerate(found) for u, g in found[k + 1 : k + 4] if u - t <= 32)
        assert list(zip(r["pair_times"], r["pair_codes"], strict=True)) == made and len(made) > 5
        assert r["feature"].startswith(f"{len(found)}:{len(made)}:")


def test_media_is_stored_and_read_back(spark, docs, tmp_path):
    stored = media.store_media(docs, str(tmp_path / "m"))
    by = {r["doc_id"]: bytes(r["media"]) for r in stored.collect()}
    assert media.wav_payload(by[7]) == media.pad("ü—😀 ß".encode()) and by[7][:4] == b"RIFF"
    assert "pair_codes" in media.media_features(docs).columns


# chat


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/[]INSTROLEs\\! a")), max_size=30))
def test_escape_is_reversible_and_hides_control(s):
    out = chat.escape(s)
    assert chat.unescape(out) == s and not any(c in out for c in chat.CONTROL)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<s>"]), st.sampled_from(["", "a", "s", "</s>", "[INST] ok [/INST]", "\\!", " x ", "A", "B"])), max_size=7))
def test_template_reads_back_and_spans_are_exact(messages):
    t = chat.InstTemplate()
    output, spans, texts, again = chat.locate(t, messages)
    assert t.read(output) == messages and not again
    assert [b for _, b in spans[:-1]] == [a for a, _ in spans[1:]]
    assert [t.texts_in(output[x[0] : x[1]]) for x in texts if x] == [m[1] for m in messages if m[0] == "assistant"]


class Forgetful(chat.InstTemplate):
    """Writes only the last user turn in full: it rewrites history."""

    def render(self, messages):
        return super().render([(r, t if k == len(messages) - 1 else t[:1]) for k, (r, t) in enumerate(messages)])


def test_rewritten_history_is_found():
    assert chat.locate(Forgetful(), [("user", "long"), ("assistant", "yes"), ("user", "more")])[3]


class Greeting(chat.InstTemplate):
    """Writes a mark before the first turn only."""

    def render(self, messages):
        return "#" + super().render(messages) if messages else ""

    def read(self, output):
        return super().read(output.removeprefix("#"))


def formatted(template, messages):
    batch = pa.RecordBatch.from_pydict({"conv_id": [1] * len(messages), "role": [r for r, _ in messages], "text": [t for _, t in messages]})
    return [r for b in chat._format(template, True)([batch]) for r in b.to_pylist()]


@pytest.mark.parametrize("n", [1, 127, 128, 129, 400])
def test_segments_join_to_one_rendering(n):
    messages = [("user" if k % 2 == 0 else "assistant", f"t{k} [INST]") for k in range(n)]
    (row,) = formatted(Greeting(), messages)
    whole = Greeting().render(messages)
    assert "".join(row["formatted"]) == whole and row["formatted_chars"] == len(whole) and row["n_turns"] == n and not row["rewrites"]
    spoken = [chat.unescape(f[a:b]) for f, flat in zip(row["formatted"], row["loss_spans"], strict=True) for a, b in zip(flat[::2], flat[1::2], strict=True)]
    assert spoken == [t for r, t in messages if r == "assistant"]


class Numbered(chat.InstTemplate):
    """Numbers its turns."""

    def render(self, messages):
        return "".join(f"{k}:{super(Numbered, self).render([m])}\n" for k, m in enumerate(messages))

    def read(self, output):
        return [m for line in output.splitlines() for m in super(Numbered, self).read(line.partition(":")[2])]


class Recent(chat.InstTemplate):
    """Keeps the last 130 turns."""

    def render(self, messages):
        return super().render(messages[-130:])


@pytest.mark.parametrize("n", [128, 129, 300])
def test_templates_that_look_far_back(n):
    messages = [("user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(n)]
    (row,) = formatted(Numbered(), messages)
    assert "".join(row["formatted"]) == Numbered().render(messages) and row["n_turns"] == n and not row["rewrites"]
    spoken = [f[a:b] for f, flat in zip(row["formatted"], row["loss_spans"], strict=True) for a, b in zip(flat[::2], flat[1::2], strict=True)]
    assert spoken == [t for r, t in messages if r == "assistant"]
    (row,) = formatted(Recent(), messages)
    assert "".join(row["formatted"]) == Recent().render(messages) and row["rewrites"] == (n > 130) and (row["loss_chars"] == 0) == (n > 130)


def test_a_rewrite_at_a_segments_start_is_found(monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 1)
    assert formatted(Forgetful(), [("user", "long"), ("user", "more")])[0]["rewrites"]


def test_conversations(spark, monkeypatch):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "user", "z"), (1, 1, "assistant", "b"), *((3, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(300))]
    df = spark.createDataFrame([*rows, (None, 1, "assistant", "y"), (-(1 << 63), 0, "user", "least id")], "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_sha256"] == hashlib.sha256(b"bb").hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest() and len(got) == 5
    assert got[None]["n_turns"] == 2 and got[None]["loss_chars"] == 1 and got[-(1 << 63)]["n_turns"] == 1
    assert got[3]["n_turns"] == 300 and got[3]["n_segments"] == 3
    assert got[3]["turns_sha256"] == hashlib.sha256("".join(f"{'user' if k % 2 == 0 else 'assistant'}\nt{k}\n" for k in range(300)).encode()).hexdigest()
    assert chat.format_conversations(df.limit(0)).count() == 0


class Late(chat.InstTemplate):
    """Writes a line first once there are over 200 turns."""

    def render(self, messages):
        return ("!" * 19 if len(messages) > 200 else "") + super().render(messages)

    def read(self, output):
        return super().read(output.lstrip("!"))


def test_a_rewrite_in_a_later_segment_empties_the_mask():
    messages = [("user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(400)]
    (row,) = formatted(Late(), messages)
    assert row["rewrites"] and row["loss_chars"] == 0 and not any(row["loss_spans"]) and row["formatted_chars"] == len(Late().render(messages))
    (row,) = formatted(Late(), messages[:200])
    assert not row["rewrites"] and row["loss_chars"] > 0


# language and mixing


def test_language_accuracy_and_odd_rows(spark, sf, docs):
    all_docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(all_docs).join(all_docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all() and got.score.between(0, 1).all()
    odd = langid.identify(docs, langid.fit(all_docs)).toPandas()
    assert len(odd) == len(ODD) and set(odd[odd.doc_id.isin([1, 2, 3, 8])].lang_pred) == {"und"} and set(odd[odd.lang_pred == "und"].score) == {0.0}
    marks = all_docs.limit(1).withColumn("text", F.lit("½ ² 12 Ⅷ —"))
    assert langid.identify(marks, langid.fit(all_docs)).first()["lang_pred"] == "und"
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert set(langid.identify(unlabelled).toPandas().lang_pred) == {"und"}
    assert langid.keep_identified(docs, langid.fit(all_docs)).columns == docs.columns
    assert langid.identify(all_docs.limit(0)).count() == 0


FOREIGN = {
    "greek": "Η γρήγορη καφέ αλεπού πηδά πάνω από το τεμπέλικο σκυλί και τρέχει μακριά μέσα στο δάσος",
    "japanese": "いろはにほへとちりぬるを わかよたれそつねならむ うゐのおくやまけふこえて あさきゆめみしゑひもせす",
    "russian": "Съешь же ещё этих мягких французских булок да выпей чаю в тихом городе у реки",
    "code": "for i in range(10):\n    if x[i] > y: print(f'{x[i]}', file=sys.stderr)\n    return dict(zip(keys, values))\n" * 4,
    "hex": "a3f9c2d0e1b47788ffcc0011deadbeef9a8b7c6d5e4f3a2b1c0d a9b8c7d6e5f41302 " * 3,
    "noise": "asdf qwer zxcv poiu lkjh mnbv qazx wsxc edcv rfvb tgbn yhnm ujmk iklo plkj hgfd " * 3,
}


def test_foreign_texts_are_rejected_and_known_ones_kept(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    junk = spark.createDataFrame([(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(FOREIGN.values())], known.schema)
    docs = known.unionByName(junk)
    got = langid.identify(docs).toPandas().set_index("doc_id")
    assert got.rejected.loc[10**6 :].all() and got.rejected.loc[: 10**6 - 1].mean() < 0.005
    kept = {r[0] for r in corpus_pipeline.identify_language(spark, docs, "").select("doc_id").collect()}
    assert not kept & set(range(10**6, 10**6 + len(FOREIGN))) and len(kept) > 0.995 * known.count()


def test_a_language_left_out_is_rejected(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(known.where("lang <> 'de'"))
    got = langid.identify(known, model).join(known.select("doc_id", "lang", "n_chars"), "doc_id").toPandas()
    long = got[got.n_chars >= 200]  # shorter texts are rejected only if their share of known n-grams is surely low
    assert long[long.lang == "de"].rejected.mean() > 0.9 and got[got.lang != "de"].rejected.mean() < 0.01


def test_rare_languages_are_learned_from(spark):
    rows = spark.range(102_000).selectExpr("id as doc_id", "if(id < 100000, concat('c', id % 10), concat('r', id % 10)) as lang", "'text' as text").unionByName(spark.createDataFrame([(10**6 + k, "few", "text") for k in range(5)], "doc_id long, lang string, text string"))
    sample = langid.bounded_sample(rows, "lang", "text", "doc_id")
    found = Counter(c for _, c in sample)
    assert len(sample) <= langid.ROWS and len(found) == 21 and found.pop("few") == 5 and min(found.values()) > 70 and max(found.values()) < 170


def test_grams_of_long_texts_are_whole(monkeypatch):
    t = "".join(random.Random(1).choices("abc dé", k=5000))
    whole = subword.counts(t)
    monkeypatch.setattr(subword, "PART", 97)
    assert (subword.counts(t) == whole).all()


def best_residual(a, target, most, passes=60_000):
    """Length of the residual of nonnegative least squares, by plain accelerated projected gradient descent."""
    d = 1 / a.sum(axis=0)
    top = np.linalg.eigvalsh((a * d) @ a.T)[-1]
    x = y = np.zeros(a.shape[1])
    k = 1.0
    for _ in range(passes):
        new = np.clip(y - d * (a.T @ (a @ y - target)) / top, 0, most)
        if ((y - new) / d) @ (new - x) > 0:
            k, y = 1.0, x
            continue
        step = (1 + np.sqrt(1 + 4 * k * k)) / 2
        x, y, k = new, new + (k - 1) / step * (new - x), step
    return np.linalg.norm(a @ x - target)


def test_rates_meet_targets(spark):
    r = np.random.default_rng(2)
    p = r.dirichlet([0.5, 0.5, 0.5], 400)
    n = r.integers(1, 500, 400)
    df = spark.createDataFrame([(float(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "tokens double, p array<double>")
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    rates, told = mixing.fit_rates(df, ["a", "b", "c"], weights, budget=float(n.sum()) / 2)
    w = np.array([x[0] for x in df.select(rates.column("p")).collect()])
    assert (w >= 0).all() and np.allclose(w * n @ p, np.array([0.5, 0.3, 0.2]) * n.sum() / 2, rtol=1e-3)
    assert told["converged"] and told["residual"] < 1e-6
    assert np.allclose(np.maximum(0, rates.start - p @ np.array(rates.step)), w)  # by hand
    capped, _ = mixing.fit_rates(df, ["a", "b", "c"], weights, most=1.0)
    assert df.select(F.max(capped.column("p"))).first()[0] <= 1


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_are_the_least_squares_optimum_on_real_documents(spark, most):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = mixing.fit_domains(docs, labels)
    scored = docs.select(mixing.posteriors(model)("text").alias("s")).select("s.*").cache()
    rates, told = mixing.fit_rates(scored, model.classes, most=most)
    rows = scored.withColumn("w", rates.column("p")).toPandas()
    a = (np.stack(rows.p) * rows.tokens.to_numpy()[:, None]).T
    target = np.array([told["target"][c] for c in model.classes])
    own = np.linalg.norm(a @ rows.w.to_numpy() - target)
    assert rows.w.min() >= 0 and (most is None or rows.w.max() <= most) and told["converged"]
    assert np.isclose(own / target.sum(), told["residual"], atol=1e-9)
    assert own <= best_residual(a, target, np.inf if most is None else most) + 1e-4 * target.sum()
    assert most is not None or told["residual"] < 1e-4


def test_too_many_domains_are_an_error(spark, docs):
    with pytest.raises(ValueError, match="domains"):
        mixing.fit_domains(docs, spark.range(100).selectExpr("id as doc_id", "id as quality", "0 as toxic"))


def test_mixing_odd_rows(spark, docs):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (None, 1, 1), (6, None, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels).toPandas()
    assert len(got) == len(ODD) and (got.rate >= 0).all() and got[got.doc_id == 1].tokens.iloc[0] == 0
    none = mixing.mix(docs, labels.limit(0)).toPandas()
    assert len(none) == len(ODD) and np.allclose(none.rate, none.rate.iloc[0])
    assert mixing.mix(docs.limit(0), labels).count() == 0
    kept = mixing.keep_mixed(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(ODD) and mixing.keep_mixed(docs.limit(0), labels).count() == 0
    assert sum(r["doc_id"] == 5 for r in kept.collect()) in (0, 2)  # repeated rows are drawn alike


# near duplicates


def words(t, width):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width, percent):
    """component by doc_id over links of full sets."""
    sets = {d: words(t, width) for d, t in rows}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    inverted = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            inverted[x].append(d)
    for d, s in sets.items():
        for e, k in Counter(e for x in s for e in inverted[x] if e > d).items():
            if 100 * k >= percent * (len(s) + len(sets[e]) - k):
                a, b = root(d), root(e)
                up[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("width", "block"), [(2, 1024), (5, 1024), (2, 24)])
def test_near_duplicates_match_brute_force(spark, sf, width, block):
    r = random.Random(4)
    base_words = [f"w{r.randrange(400)}" for _ in range(90)]
    rows = [(k, r.choice(["", " "]) + " ".join(w if r.random() > 0.05 else f"z{r.randrange(50)}" for w in base_words)) for k in range(120)]
    rows += [(1000 + k, " ".join(f"w{r.randrange(60)}" for _ in range(r.randrange(1, 9)))) for k in range(300)]
    rows += [(d + 2000, t) for d, t in ((r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())]
    rows += [(9000, None), (9001, " "), (9002, "One"), (9003, "one"), (9004, "É"), (9005, "é")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, 80, block).toPandas()
    want = brute(rows, width, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_near_duplicates_odd_rows(spark, docs):
    got = minhash.near_duplicates(docs, 2).toPandas()
    assert len(got) == len(ODD) and got[got.doc_id.isna()].kept.all()
    assert set(got[got.doc_id.isin([4, 5])].component_id) == {4}
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r[0] or 0 for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_registers_estimate():
    r = np.random.default_rng(3)
    a = np.unique(r.integers(0, 2**64, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:3600], r.integers(0, 2**64, 400, dtype=np.uint64)]))
    (ra, fa), (rb, fb) = minhash.registers(a), minhash.registers(b)
    j, e = minhash.estimates(np.stack([ra, rb]), np.stack([fa, fb]), np.array([len(a), len(b)]), 0)
    assert abs(j[0] - 3600 / 4400) < 4 * e[0]


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in base.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got) == {*range(100, 161), *range(7, 60)} and {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(7, 60)} == {7}


@pytest.mark.parametrize("alone", [0, 10_000])
def test_components_by_one_task_and_by_rounds(spark, alone):
    r = random.Random(5)
    edges = [(r.randrange(900), r.randrange(900)) for _ in range(420)] + [(k + 1, k) for k in range(2000, 2300)] + [(5000, 4000 + k) for k in range(50)] + [(-3, 2**40), (6, 6), (2**40, -3)]
    forest = base.Forest(len(nodes := sorted({x for e in edges if e[0] != e[1] for x in e})))
    at = {x: k for k, x in enumerate(nodes)}
    for u, v in edges:
        if u != v:
            forest.join(at[u], at[v])
    got = [tuple(x) for x in base.components(spark.createDataFrame(edges, "u long, v long"), alone=alone).collect()]
    assert sorted(got) == [(x, nodes[forest.root(at[x])]) for x in nodes]
    assert base.components(spark.createDataFrame([], "u long, v long"), alone=alone).count() == 0


def test_only_texts_of_dropped_or_repeated_ids_are_shuffled(spark):
    """The sieve stands below the join with the kept ids, so that other texts do not reach its exchange."""
    words = [" ".join(f"w{k}x{i}" for i in range(12)) for k in range(300)]
    docs = spark.createDataFrame([(k, words[k % 300], "s") for k in range(310)] + [(299, "once more", "t")], "doc_id long, text string, source string").cache()
    kept = minhash.keep_first(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(re.match(r"[\s:+|-]*", x)[0]) for x in plan]
    (at,) = (k for k, x in enumerate(plan) if "Join" in x and "doc_id_of_kept" in x)
    below = [plan[k] for k in range(at + 1, next((k for k in range(at + 1, len(plan)) if depth[k] <= depth[at]), len(plan)))]
    assert any("Join" in x and "bucket_of_sieve" in x for x in below)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300))


def test_components_of_a_small_graph_take_few_jobs(spark):
    """Each job leaves records and threads in the driver."""
    sc = spark.sparkContext
    sc.setJobGroup("few", "few")
    try:
        assert base.components(spark.createDataFrame([(k, k + 1) for k in range(200)], "u long, v long")).where("component = 0").count() == 201
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("few")) <= 12


def test_sketches_ask_for_every_pair_within_the_margin():
    r = np.random.default_rng(12)
    pool = r.integers(0, 2**64, 300, dtype=np.uint64)
    sets = [np.unique(r.choice(pool, r.integers(100, 300), replace=False)) for _ in range(60)]
    made = [minhash.registers(s) for s in sets]
    reg, full, size = np.stack([x[0] for x in made]), np.stack([x[1] for x in made]), np.array([len(s) for s in sets])
    component, side = r.integers(0, 5, 60), r.integers(0, 2, 60)
    out = minhash.asked(reg, full, size, component, side, 80)
    pairs = [(i, j) for i in range(60) for j in range(60) if side[i] == 0 and side[j] == 1 and component[i] != component[j] and minhash.alike(sets[i], sets[j], 80)]
    assert pairs and all(out[i] and out[j] for i, j in pairs) and out.sum() < 60


def test_hot_keys_are_looked_up_alike(spark, monkeypatch):
    monkeypatch.setattr(base, "HOT", 5)
    monkeypatch.setattr(base, "HOTS", 30)
    left = spark.range(200).selectExpr("if(id < 120, 1, id % 40) as k", "id as x")
    right = base.cut(left.groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("top")).where("k <> 7"))
    for how in ("inner", "left"):
        want = left.join(right.drop("n"), "k", how)
        got = base.lookup(left, right, "k", how=how)
        assert got.columns == ["k", "x", "top"] and sorted(map(str, got.collect())) == sorted(map(str, want.select("k", "x", "top").collect()))
    monkeypatch.setattr(base, "HOT", 10)
    edges = [(k, k + 1) for k in range(100, 130)] + [(7, k) for k in range(8, 60)]
    got = {r["node"]: r["component"] for r in base.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[k] for k in range(100, 131)} == {100} and {got[k] for k in range(7, 60)} == {7}


def test_vectors_of_many_lengths(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SIZES", 2)
    r = np.random.default_rng(9)
    rows, want = [], {}
    for size in range(1, 40):
        x = r.normal(size=(4, size))
        x = np.concatenate([x, x[:2] + 0.01 * r.normal(size=(2, size))])
        u = embeddings.unit(x)
        for k, n in enumerate((u @ u.T >= 0.95).sum(axis=1) - 1):
            rows.append((len(rows), [float(v) for v in x[k]]))
            want[len(rows) - 1] = n
    got = {v["vec_id"]: v["n_links"] for v in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95, block=3).collect()}
    assert got == want


@pytest.mark.parametrize(("pivots", "block"), [(192, 8192), (8, 40)])
def test_near_vectors_match_brute_force(spark, pivots, block):
    r = np.random.default_rng(6)
    centre = r.normal(size=(12, 16))
    x = np.concatenate([centre[r.integers(0, 12, 260)] + r.normal(size=(260, 16)) * r.choice([0.05, 0.3], (260, 1)), r.normal(size=(60, 16))]).astype(np.float32)
    x[5] = x[9]
    rows = [(k, [float(v) for v in v], k % 3) for k, v in enumerate(x)] + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [1.0, 2.0], 1), (905, [2.0, 4.0], 1), (906, [], 1), (None, [1.0] * 16, 0)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit(2)), 0.95, pivots, block).toPandas()
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = near.sum(axis=1) - 1
    by = got.dropna(subset=["vec_id"]).astype({"vec_id": int}).set_index("vec_id")
    assert len(got) == len(rows) and by.n_links.loc[range(320)].tolist() == want.tolist()
    label = np.arange(320)
    for _ in range(320):
        label = np.array([label[near[k]].min() for k in range(320)])
    assert by.loc[range(320)].component_id.tolist() == label.tolist()
    assert by.n_links.loc[[900, 901, 902, 903, 906]].sum() == 0 and by.n_links.loc[904] == 1 and by.component_id.loc[905] == 904


@pytest.mark.parametrize("d", [1, 3, 64, 300, 2500])
@pytest.mark.parametrize("threshold", [0.5, 0.95])
def test_tiles_match_brute_force(d, threshold):
    rng = np.random.default_rng(d)
    loose = embeddings.unit(rng.normal(size=(600, d)))
    close = embeddings.unit(loose[rng.integers(0, 40, 600)] + 0.3 * rng.normal(size=(600, d)) / np.sqrt(d))
    for u in (loose, close):
        sure, maybe = ({(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T >= threshold + off, 1)), strict=True)} for off in (1e-12, -1e-12))
        whole = {(i, j) for a, b in embeddings.tile(u, None, threshold) for i, j in zip(a, b, strict=True)}
        parts = {(i, j + 300) for a, b in embeddings.tile(u[:300], u[300:], threshold) for i, j in zip(a, b, strict=True)}
        assert sure <= whole <= maybe
        assert {p for p in sure if p[0] < 300 <= p[1]} <= parts <= maybe


def test_error_bounds_hold():
    r = np.random.default_rng(8)
    u = embeddings.unit(r.normal(size=(200, 64)))
    q, s, e = embeddings.quantise(u)
    close = (q.astype(np.float64) @ q.T.astype(np.float64)) * s[:, None] * s[None, :]
    assert (np.abs(close - u @ u.T) <= e[:, None] + e[None, :] + e[:, None] * e[None, :]).all()


# tokens and packing


@pytest.fixture(scope="module")
def enc():
    return tokens.encoder(public_tokenizers.path(tokens.VOCABULARY))


def test_ids_are_the_tokenizers(enc, texts):
    t = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    for x in [*list(texts.values())[:60], "a <|endoftext|> b", "  \n\n x'll don't\t  ", "ü😀\x00", "ab" * 5000]:
        assert enc.ids(x) == t.encode(x, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" + " " * 1_300_000 + "b", "\n" * 1_200_000, "word" + "\u3000" * 1_200_000])
def test_white_space_of_any_length(enc, text):
    own = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY)).encode(text, add_special_tokens=False).ids
    assert enc.ids(text) == own and tokens.EditedText(text, enc).count == len(own)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1 '\n\tlr.é")), max_size=400), st.lists(st.tuples(st.integers(0, 420), st.integers(0, 420), st.text(alphabet=st.sampled_from(list("ab1 'le\n")), max_size=12)), max_size=6))
def test_edits_keep_counts(text, edits):
    e = tokens.encoder(public_tokenizers.path(tokens.VOCABULARY))
    t = tokens.EditedText(text, e)
    for a, b, put in edits:
        a = min(a, len(text))
        b = max(a, min(b, len(text)))
        t.edit(a, b, put)
        text = text[:a] + put + text[b:]
        assert t.text == text and t.count == len(e.fast.encode_ordinary(text))


def test_edits_are_local(enc, texts):
    long = max(texts.values(), key=len)
    t = tokens.EditedText(long, enc)
    t.edit(len(long) // 2, len(long) // 2 + 3, "xyz")
    assert t.encoded < 3000 < len(long)


def test_edits_stay_local_after_a_long_insert(enc):
    t = tokens.EditedText("", enc)
    t.edit(0, 0, "word abc " * 77_000)
    t.encoded = 0
    for at in (5, 300_000, 692_000):
        t.edit(at, at + 1, "q")
    assert t.encoded < 3 * 1500 and t.count == len(enc.ids(t.text))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<|", "endoftext", "|>", "<|endoftext|>", " ", "  ", "a", "\n", "12345"]), max_size=120), st.lists(st.tuples(st.integers(0, 500), st.integers(0, 15), st.sampled_from(["", "|>", "<|", "<|endoftext|>", "x", " "])), max_size=6))
def test_special_tokens_count_as_the_tokenizers(parts, edits):
    e = tokens.encoder(public_tokenizers.path(tokens.VOCABULARY))
    text = "".join(parts)
    t = tokens.EditedText(text, e)
    for a, n, put in edits:
        a = min(a, len(text))
        t.edit(a, a + n, put)
        text = text[:a] + put + text[a + n :]
        assert t.text == text and t.count == len(e.ids(text))


def test_trees_serve_further_edits(spark, docs, texts, enc):
    rows = spark.createDataFrame(list(texts.items())[:40], "doc_id long, text string").withColumn("edits", queries.sample_edits())
    once = tokens.edit_trees(tokens.count_trees(rows, "edits"))
    again = tokens.edit_trees(once.drop("n_tokens").withColumnRenamed("n_tokens_after", "n_tokens").withColumn("edits", F.expr("array(struct(50 as start, 52 as stop, '<|endoftext|> it' as put))"))).collect()
    for r in again:
        assert r["n_tokens_after"] == len(enc.ids(r["text"])) == sum(r["leaf_tokens"]) and sum(r["leaf_chars"]) == len(r["text"]) == r["n_chars_after"]
        assert r["n_chars_encoded_again"] < 1500 or len(r["text"]) < 1500
    assert max(len(r["leaf_chars"]) for r in again) > 3
    odd = tokens.edit_trees(tokens.count_trees(docs).withColumn("leaf_chars", F.lit(None).cast("array<int>"))).collect()
    assert len(odd) == len(ODD) and all(r["n_tokens"] == r["n_tokens_after"] for r in odd)
    assert tokens.edit_trees(tokens.count_trees(docs.limit(0))).count() == 0


def test_edited_counts_query(spark, docs, texts, sf, enc):
    odd = tokens.edited_counts(docs.withColumn("edits", queries.sample_edits())).toPandas()
    assert len(odd) == len(ODD) and odd[odd.doc_id == 1].n_tokens.iloc[0] == 0
    got = queries.op7_tokens(spark, sf).toPandas()
    exact = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    count = lambda x: len(exact.encode(x, add_special_tokens=False).ids)
    for r in got.itertuples():
        x = texts[r.doc_id]
        third, half = len(x) // 3, len(x) // 2
        y = x[:third] + x[third + 20 :]
        y = y[:half] + " words put in " + y[half:]
        y = "Z" + y[1:]
        assert (r.n_tokens, r.n_tokens_after, r.crc32_after) == (count(x), count(y), zlib.crc32(y.encode()))


def test_packing_is_exact(spark, docs, texts, enc):
    many = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(70)
    got = packing.pack(many).toPandas()
    ids = {d: tokens.ids_of(t, enc, 1) for d, t in texts.items()}
    for d, g in got.groupby("doc_id"):
        g = g.sort_values("start")
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1].tolist()] and g.length.sum() == len(ids[d]) == g.doc_tokens.iloc[0]
        assert all(zlib.crc32(ids[d][s : s + n].tobytes()) == c for s, n, c in zip(g.start, g.length, g.ids_crc32, strict=True))
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1].tolist()]
        n = g.length.sum()
        assert n <= 2048 and n & (n - 1) == 0
    odd = packing.pack(docs).toPandas()
    assert len(odd.doc_id.dropna().unique()) == 8 and odd[odd.doc_id == 1].doc_tokens.iloc[0] == 1
    assert packing.pack(docs.limit(0)).count() == 0


# WARC


def test_archive_with_decoys(spark, sf):
    fake = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\n" + "z" * 200
    odd = [(10**6, "u", fake), (10**6 + 1, None, None), (10**6 + 2, "v\r\nq", "WARC/1.1\r\n"), (10**6 + 3, "v", "y" * 120), (10**6 + 5, "v", "y" * 120), (10**6 + 6, "v", "short"), (10**6 + 7, "v", "short"), (10**6 + 8, "v", "é" * 70), (10**6 + 9, "v", fake)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        pages = spark.read.parquet(f"{sf}/pages.parquet").unionByName(spark.createDataFrame(odd, "page_id long, url string, html string")).withColumn("n", F.lit(1))
        got = warc.archive_pages(pages).toPandas().set_index("page_id")
        rows = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
        assert warc.archive_pages(pages.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    first = {}
    for k in sorted(rows):
        first.setdefault(rows[k], k)
    assert len(got) == len(rows)
    for k, b in rows.items():
        again = len(b) >= 100 and first[b] != k
        r = got.loc[k]
        assert (r.payload_bytes, r.payload_digest, r.record_type) == (len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response")
        assert r.refers_to == first[b] if again else np.isnan(r.refers_to)


def test_archive_with_repeated_version_lines(spark):
    line = "WARC/1.1\r\n"
    bodies = [line * 2, "a" + line * 3 + "b", line * 4000, f"x{line}{line}WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n{line}{line}", "plain"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        pages = spark.createDataFrame([(k, "u", b) for k, b in enumerate(bodies)], "page_id long, url string, html string").coalesce(1)
        got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.archive_pages(pages).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: (len(b), hashlib.sha256(b.encode()).hexdigest()) for k, b in enumerate(bodies)}


# HTML


def test_main_text_of_pages(spark, sf):
    def want(h):
        h = h.split("<article>")[1].split("</article>")[0].replace("<b>", "").replace("<br>", " ")
        parts = [h]
        for tag in ("<p>", "</p>", "<h1>", "</h1>"):
            parts = [y for x in parts for y in x.split(tag)]
        return "\n".join(y for y in (" ".join(entities.unescape(x).split()) for x in parts) if y)

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html.main_text(pages.withColumn("text", F.lit("clash"))).toPandas()
    assert len(got) == len(source) and all(t == want(source[k]) for k, t in zip(got.page_id, got.text, strict=True))
    assert (got.n_chars == got.text.str.len()).all() and got.wrapper_matched.all()


SITE = "<html><head><title>T</title></head><body class='has-sidebar'><header><a href=/>Site</a></header><nav><ul><li>A<li>B</ul></nav>{note}<main><h1>{title}</h1>{body}<section class='comments'><p>nice!</p></section></main><aside>side</aside><form><label>mail</label><input></form><footer>end</footer><script>x='<p>no</p>'</script></body></html>"


def test_wrappers_generalise():
    pages = [SITE.format(note=n, title=f"t{k}", body="".join(f"<p>par {k} {j} &amp; x<br>y</p>" for j in range(k + 1))) for k, n in enumerate(["", "<div class='cookie-notice'>ok?</div>", ""])]
    w = html.infer(pages)
    written = html.dump(3, w)
    assert '"?"' in written and '"+"' in written and html.label(html.load(written)[1], 3) == w
    for k, p in enumerate(pages):
        text, matched = html.extract(p, w)
        assert matched and text == "\n".join([f"t{k}", *(f"par {k} {j} & x y" for j in range(k + 1))])
    new = SITE.format(note="", title="t", body="<p>a</p>" * 9)
    assert html.extract(new, w) == ("\n".join(["t", *"a" * 9]), True)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><div class='wrap has-sidebar'><div class='no-comments'><h1>T</h1><p>a</p></div><div class=sidebar>s</div></div></body>", "T\na"),
        ("<body><div class='top-nav'>n</div><div class=post><h2>T</h2>a <b>b</b> c<br>d<div>e</div>f</div><div class='comment-list'><p>c</p></div><div id=cookieBanner>ok</div></body>", "T\na b c d\ne\nf"),
        ("<article><header><h1>T</h1></header><p>a<!--> b <!-- x --!> c<p title='x>y'>d &lt;b&gt; &#65;&nbsp;e</p><footer>f</footer></article>", "T\na b c\nd <b> A e"),
        ("<article><p>a<p>b<div>c</div>d<ul><li>e<li>f</ul><table><tr><td>1<td>2</table><script>var x='</article>';", "a\nb\nc\nd\ne\nf\n1\n2"),
    ],
)
def test_pages_of_other_makes(page, text):
    assert html.extract(page, None)[0] == text


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ('<p>one</p><svg class="i"/><p>two</p>', "one\ntwo"),
        ("<p>one <svg width='1' data-x = 2 /> a</p><SVG/><p>two</p><svg><path d='M0'/><text>no</text></svg>", "one a\ntwo"),
        ("<p>one</p><svg href=a/>no</svg><p>two</p>", "one\ntwo"),
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding=tex>x=1</annotation></math> then <math/> b</p>", "if x=1 then b"),
    ],
)
def test_foreign_elements_end_at_their_tag(inner, text):
    assert html.extract(f"<article>{inner}</article>", None)[0] == text


def test_pages_of_several_layouts_lose_no_text():
    one = "<html><body><div class=menu>m</div><h1>{t}</h1><div><div>long text of the page {t}</div></div><section>more</section></body></html>"
    other = "<html><body><div class=menu>m</div><section><p>article {t}</p></section></body></html>"
    main, bare = "<body><main><p>in main</p></main></body>", "<body><div><p>in div</p></div><footer>f</footer></body>"
    w = html.infer([one.format(t=k) for k in range(3)] + [other.format(t="x")])
    assert html.extract(one.format(t=1), w) == ("1\nlong text of the page 1\nmore", True)
    assert html.extract(other.format(t="x"), w) == ("article x", True)
    w = html.infer(["<body><nav>n</nav><article>a</article></body>", main, bare])
    assert [html.extract(p, w) for p in (main, bare)] == [("in main", True), ("in div", True)]
    assert html.extract("<h3>new</h3><body><ol><li>layout</ol></body>", w) == ("new\nlayout", False)


def tag_soup(rng):
    tags = ["p", "h2", "ul", "li", "div", "section", "nav", "b", "br", "article", "header", "td", "table"]
    return "".join(rng.choice(["<%s>", "</%s>", "<%s class=sidebar>"]) % rng.choice(tags) if rng.random() < 0.6 else f"w{rng.randrange(9)} " for _ in range(rng.randrange(40)))


def counted(units):
    """(texts, characters) that a wrapper's units count."""
    texts = chars = 0
    for u in units:
        for own in html.kinds(u).values():
            n, c = (own[2], own[3]) if own[0] == html.TEXT else counted(own[2])
            texts, chars = texts + n, chars + c
    return texts, chars


def test_wrappers_match_and_count_every_page_they_come_from():
    """In any order, and aligned from parts."""
    rng = random.Random(1)
    for _ in range(300):
        streams = [t for t in (html.tokens(tag_soup(rng)) for _ in range(6)) if t]
        parts = [None, None]
        for k, t in enumerate(streams):
            parts[k % 2] = html.add_page(parts[k % 2], t)
        nodes = html.generalise(parts[0] or [], parts[1] or [])
        assert html.load(html.dump(len(streams), nodes)) == (len(streams), nodes)
        assert counted(nodes) == (sum(x[0] == "t" for t in streams for x in t), sum(len(x[1]) for t in streams for x in t if x[0] == "t"))
        for t in streams:
            met = []
            assert html.parse(nodes, t, 0, met) == len(t) == len([x for x in t if x[0] == ">"]) + len(met)


def neutral(page):
    """The page without classes and without elements that say what they hold."""
    return re.sub(r"<(/?)(article|main|nav|footer|header|aside|section)\b", r"<\1div", re.sub(r" (class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page))


def article_of(h):
    h = h.split("<article>")[1].split("</article>")[0].replace("<b>", "").replace("<br>", " ")
    parts = [h]
    for tag in ("<p>", "</p>", "<h1>", "</h1>"):
        parts = [y for x in parts for y in x.split(tag)]
    return "\n".join(y for y in (" ".join(entities.unescape(x).split()) for x in parts) if y)


def test_pages_with_neutral_names(spark):
    """Every page keeps its article and nothing else, by structure alone; what a page's own wrapper cannot tell, its host's can."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"], neutral(r["html"])) for r in pages.collect()]
    want = {r["page_id"]: article_of(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want
    alone = {k: html.extract(h, None)[0] for k, _, h in rows}
    assert 0 < sum(alone[k] != want[k] for k in want)


def test_the_wrapper_decides():
    """Without names: a recurring note, a varying short one, link lists and a rare layout."""
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["deep", "sea", "floor", "maps", "show", "ridges"]) for _ in range(n))
    page = "<body><div><div><ul>{links}</ul></div><div><h3>Keep up</h3>Join our list to hear of new maps.</div><div>{ad}</div><div><h1>{title}</h1>{text}</div><div><h3>See</h3><ul>{links}</ul></div></div></body>"
    links = lambda: "".join(f"<li><a href=/{k}>{say(2)}</a></li>" for k in range(4))
    made = [(say(3), [say(40) for _ in range(4)]) for _ in range(12)] + [(say(2), [say(3)])]
    pages = [page.format(links=links(), ad=say(4), title=t, text="".join(f"<p>{x}</p>" for x in ps)) for t, ps in made]
    rare = f"<body><section><h2>Rare</h2><blockquote>{say(30)}</blockquote></section></body>"
    w = html.infer([*pages, rare])
    for (t, ps), h in zip(made, pages, strict=True):
        assert html.extract(h, w) == ("\n".join([t, *ps]), True)
    assert html.extract(pages[-1], None)[0] != html.extract(pages[-1], w)[0]  # a short article: alone, it is like its notes
    assert html.extract(pages[0], None)[0] != html.extract(pages[0], w)[0]  # the note with a heading recurs only on other pages
    assert html.extract(rare, w)[0].startswith("Rare\n") and len(html.extract(rare, w)[0]) > 60


def test_names_do_not_outweigh_structure():
    long = "<p>" + "word " * 80 + "</p>"
    kept = html.extract(f"<body><div class='content-sidebar'><h1>T</h1>{long * 4}</div><div class=footer>f</div></body>", None)[0]
    assert kept.startswith("T\nword") and "f" not in kept.split("\n")
    comments = f"<div class=comments>{'<p>' + 'nice ' * 60 + '</p>'}</div>"
    assert "nice" not in html.extract(f"<body><div class=post>{long * 2}</div>{comments * 3}</body>", None)[0]


@pytest.mark.parametrize("page", ["<a " * 400_000 + '"', "<p a='" * 200_000, "<!--" * 200_000, "<svg " * 200_000, "<" * 1_000_000, "&#" + "9" * 300_000 + ";", "<svg>" + "</svg" * 200_000, "<script>" * 200_000, "<p " + "x " * 500_000], ids=range(9))
def test_hostile_pages_are_read_in_one_pass(page):
    start = time.monotonic()
    html.tokens(page)
    assert time.monotonic() - start < 3


def test_attributes_as_browsers_read_them():
    assert html.extract("""<article><p title="a>b" x='>' y=a"b>one</p><p class=x">two</p><a "q>three</a></article>""", None)[0] == "one\ntwo\nthree"
    assert html.extract("<article><p>one</p><p title='open>two</p></article>", None)[0] == "one"


def test_wrappers_beyond_the_broadcast(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("url", F.concat(F.lit("http://h"), (F.col("page_id") % 5).cast("string"), F.lit("/")))
    want = {r["page_id"]: r["text"] for r in html.main_text(pages).collect()}
    for size in (0, 3000):
        monkeypatch.setattr(html, "BROADCAST", size)
        got = html.main_text(pages).collect()
        assert {r["page_id"]: r["text"] for r in got} == want and all(r["wrapper_matched"] for r in got)


def test_siblings_begin_differently():
    rng = random.Random(2)
    w = html.infer([tag_soup(rng) for _ in range(60)])

    def check(units):
        found = [k for u in units for k in html.keys(u)]
        assert len(found) == len(set(found))
        for u in units:
            for own in html.kinds(u).values():
                if own[0] == "e":
                    check(own[2])

    check(w)


def test_deep_and_long_pages():
    deep, long = "<div>" * 3000 + "x<p>y", "<article>" + "<p>a</p><h2>b</h2>" * 5000 + "</article>"
    w = html.infer([deep, deep[:9000], long])
    assert html.extract(long, w) == ("\n".join("ab" * 5000), True) and len(html.dump(1, html.infer([long]))) < 300
    assert html.extract(deep, html.infer([deep])) == ("x\ny", True)
    assert html.extract("<ul>" * 5000 + "</ol></div>" * 5000, w)[0] == ""


def test_html_odd_rows(spark):
    rows = [(1, None, None), (2, "http://h/", ""), (3, "http://h/", "plain &lt;text&gt; 3 < 4"), (4, "http://h/", "<p>cut <b>of"), (5, "http://h/", "<article><p>one<p>two <!-- c --> end<br>x<style>p{}</style></article>"), (6, "http://h/", "<div>a</div><div class=ad>b</div><di"), (None, "u", "<p>z")]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).toPandas()
    by = {None if r.page_id != r.page_id else int(r.page_id): r.text for r in got.itertuples()}
    assert by[1] == by[2] == "" and by[5] == "one\ntwo end x" and by[4] == "cut of" and by[3] == "plain <text> 3 < 4" and by[6] == "a" and by[None] == "z"
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# pipeline


def test_pipeline_against_its_parts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    one = corpus_pipeline.identify_language(spark, docs, sf).cache()
    kept = {r["doc_id"]: r["text"] for r in one.collect()}
    two = corpus_pipeline.drop_near_duplicates(spark, one, sf).cache()
    want = brute(list(kept.items()), 5, 80)
    assert sorted(r["doc_id"] for r in two.collect()) == sorted({c for _, c in want.values()})
    three = corpus_pipeline.mix_sources(spark, two, sf).cache()
    assert one.columns == two.columns == three.columns == names
    # mixing by hand: the same rates and draws, document by document
    model = mixing.fit_domains(two, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = two.select("doc_id", "text", (F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)).alias("draw")).toPandas()
    p, n = np.stack([model.posterior(t or "") for t in rows.text]), np.array([len((t or "").split()) for t in rows.text], float)
    share = np.array([mixing.WEIGHTS.get(c, 0.0) for c in model.classes])
    budget = min(h / s for h, s in zip(n @ p, share / share.sum(), strict=True) if s > 0)
    rates, told = mixing.fit_rates(two.select(mixing.posteriors(model)("text").alias("s")).select("s.*"), model.classes, most=1.0)
    w = np.clip(rates.start - p @ np.array(rates.step), 0, 1)
    assert np.isclose(sum(told["target"].values()), budget) and told["converged"]
    a = (p * n[:, None]).T
    assert np.linalg.norm(a @ w - share / share.sum() * budget) <= best_residual(a, share / share.sum() * budget, 1.0) + 1e-4 * budget
    wanted = {d for d, x, u in zip(rows.doc_id, w, rows.draw, strict=True) if np.floor(x + u) > 0}
    assert {r["doc_id"] for r in three.collect()} == wanted and 0 < len(wanted) <= len(rows)
    # packing: every id of every document of the third stage, once and in place
    packed = corpus_pipeline.run(spark, sf).toPandas()
    e = tokens.encoder(public_tokenizers.path(tokens.VOCABULARY))
    ids = {r["doc_id"]: tokens.ids_of(r["text"] or "", e, 1) for r in three.collect()}
    assert set(packed.doc_id) == set(ids)
    for d, g in packed.sort_values("start").groupby("doc_id"):
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1].tolist()] and g.length.sum() == len(ids[d])
        assert all(zlib.crc32(ids[d][s : s + k].tobytes()) == c for s, k, c in zip(g.start, g.length, g.ids_crc32, strict=True))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "mixing", "packing"]


def test_sql_of_queries(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got, want = queries.queries()[name](spark, sf).toPandas(), con.execute(sql).df()
        key = sorted(want.columns)
        rows = [sorted((tuple(None if v != v or v is None else v for v in r) for r in d[key].astype(object).where(d[key].notna(), None).itertuples(index=False)), key=str) for d in (got, want)]
        assert rows[0] == rows[1], name
