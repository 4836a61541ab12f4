"""Every operator on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns, and on none."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from urbanframe.llm import chat_format, decontamination, exact_dedup, language_id, near_dedup, sentencepiece_codec, sharding, substring_dedup, token_store, url_filter
from urbanframe.llm.common import new_path

CLASH = "hash long, norm string, rank int, best string, head string, h long, id string, part string, place int, to int, row long, row_no long, c0 long, keep_id long, shard int, lang_pred string, ids string, kept string, n_words string, digest string, num string, decoded string, size string"


def _texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    words = ["der", "the", "of", "und", "Haus", "house", "río", "cat", "été", "x1", "...", "日本"]
    base = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 80)))) for i in range(12)]
    rows += [(20, base), (21, base.replace(" ", "\n")), (22, base), (22, base), (23, base + " extra words at the end"), (24, base.upper())]
    rows += [(30, None), (31, ""), (32, " \t\r\n"), (33, "ONE"), (34, "one"), (35, "a b"), (36, "12 34 !!"), (None, "no id"), (None, None), (40, " ".join(rng.choice(words) for _ in range(20000)))]
    return rows


ROWS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    extra = tuple(None for _ in CLASH.split(","))
    return spark.createDataFrame([(d, t, "en" if d and d % 2 else None, *extra) for d, t in ROWS], f"doc_id long, text string, lang string, {CLASH}").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id = -5")


def _blank(text):
    return "".join(c for c in text or "" if c not in " \t\n\r\x0b\x0c")


def test_exact(docs, none):
    got = exact_dedup.exact_groups(docs, heavy_parts=4).collect()
    assert len(got) == len(ROWS) and exact_dedup.exact_groups(none).count() == 0
    groups, firsts = {}, {}
    for d, t in ROWS:
        groups.setdefault(_blank(t), []).append((-len(t or ""), d if d is not None else 10**9, d))
    for r in got:
        members = groups[_blank(r.text)]
        assert (r.group_size, r.keep_id) == (len(members), min(members, key=lambda m: m[:2])[2])
        assert r.kept == (r.doc_id == r.keep_id)
        firsts[_blank(r.text)] = firsts.get(_blank(r.text), 0) + r.first
        assert r.kept or not r.first
        assert r.text_sha256 == hashlib.sha256(_blank(r.text).encode()).hexdigest()
    assert set(firsts.values()) == {1} and all(r.hash is None and r.row is None and r.c0 is None for r in got)
    few = docs.select(docs.doc_id.cast("string").alias("doc_id"), "text")
    assert {r.keep_id for r in exact_dedup.exact_groups(few.filter("doc_id IN ('20', '22')")).collect()} == {"20"}


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_sharding(docs, none, law):
    got = sharding.shard(docs, 4, law).collect()
    assert len(got) == len(ROWS) and sharding.shard(none, 4, law).count() == 0
    slots = {}
    for r in got:
        assert r.size == len((r.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if law == "rows":
        sizes = [len(slots.get(k, [])) for k in range(4)]
        assert max(sizes) - min(sizes) <= 1 or len({(r.doc_id, r.text) for r in got}) < len(got)
    else:
        total, largest = sum(r.size for r in got), max(r.size for r in got)
        assert all(abs(sum(r.size for r in got if r.shard == k) - total / 4) <= largest for k in range(4))


def _stripped(rows, window):
    seen, out = {}, {}
    keyed = sorted({(d if d is not None else -(2**63), " ".join((t or "").encode().split() and [w.decode() for w in (t or "").encode().split()] or [])) for d, t in rows})
    for d, joined in keyed:
        words = joined.split(" ") if joined else []
        for p in range(len(words) - window + 1):
            seen.setdefault(tuple(words[p : p + window]), []).append((d, joined, p))
    for d, joined in keyed:
        words = joined.split(" ") if joined else []
        gone = set()
        for p in range(len(words) - window + 1):
            if min(seen[tuple(words[p : p + window])]) < (d, joined, p):
                gone.update(range(p, p + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d, joined] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring(docs, none, spark):
    assert substring_dedup.strip_repeats(none).count() == 0
    first = next((d, t) for d, t in ROWS if d == 20)
    rows = [*ROWS, first, first, (None, first[1] + " and the end"), (50, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = lambda t: " ".join(w.decode() for w in (t or "").encode().split())
    expected = _stripped(rows, 20)
    got = substring_dedup.strip_repeats(df).collect()
    assert Counter(tuple(r) for r in got) == Counter((d, *expected[-(2**63) if d is None else d, words(t)]) for d, t in rows)
    assert substring_dedup.strip_repeats(docs).count() == len(ROWS)


def _components(rows, size):
    sets = {}
    for d, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets.setdefault(d, set()).add(frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset())
    ids = sorted(sets)
    label = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] < label[a] and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                    label[a], changed = label[b], True
    return label


def test_near(docs, none, spark):
    assert near_dedup.near_components(none, 2).count() == 0
    rows = [(d, t) for d, t in ROWS if d is not None]
    got = near_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    label = _components(rows, 2)
    assert {(r.doc_id, r.component_id) for r in got} == set(label.items()) and all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_components(docs, 2).count() == len(ROWS)


@pytest.mark.parametrize("spread", [0, 60])
def test_near_blocks(spark, monkeypatch, spread):
    """A crowded bucket of near texts, of one length or of many."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(50 + spread)]
    rows = []
    for i in range(60):
        own = list(base)[: 50 + rng.randint(0, spread)]
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(50)] = rng.choice(words)
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "LARGE", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near_dedup, "PAIRS_EACH", 10**9)
    assert {r.doc_id: r.component_id for r in near_dedup.near_components(df, 2).collect()} == _components(rows, 2)


def test_language(docs, none, spark):
    langs = {"en": "the house of the rising sun and that other thing", "de": "der und das nicht ein Haus mit dem Garten"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.sample(langs[x].split(), 8)), x) for i in range(200) for x in langs]
    train = spark.createDataFrame([(2 * i + (x == "de"), t, x) for i, t, x in rows], "doc_id long, text string, lang string")
    model = language_id.learn(train)
    got = language_id.identify(train, model).withColumn("held", language_id.held_out()).filter("held").collect()
    assert got and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    messy = language_id.identify(docs, model).collect()
    assert len(messy) == len(ROWS) and all(0 <= r.score <= 1 for r in messy)
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in messy)
    assert language_id.identify(none, model).count() == 0 and language_id.learn(none).langs == ()
    assert {r.lang_pred for r in language_id.identify(docs, language_id.learn(none)).collect()} == {"und"}


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.COM/en/x?q#f"), (4, "http://www.example.com/en/"), (5, "http://b.net/es/1"), (6, "http://b.net"), (7, "https://x.org#a"), (None, "http://b.net/fr/"), (8, "http://bad.org/1"), (8, "http://bad.org/1")]
    pages = spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(8, 1), (8, 0), (6, 0), (None, 1), (3, None)], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, outcomes).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("", "", None, "allow") and got[2].host == ""
    assert (got[3].host, got[3].path, got[3].rule, got[3].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert (got[4].rule, got[4].verdict) == ("www.example.com/en/", "allow") and (got[5].rule, got[5].verdict) == ("net/es/", "block")
    assert (got[6].path, got[6].rule) == ("", None) and got[7].host == "x.org" and got[None].rule == "net/fr/"
    assert url_filter.judge_urls(pages, outcomes).count() == len(rows)
    assert url_filter.judge_urls(pages.filter("page_id = 99"), outcomes.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, outcomes.limit(0), rules=()).collect()} == {"allow"}


def _quantile(a, b, share=0.05):
    """Of a beta distribution, by summing its density."""
    x = (np.arange(200_000) + 0.5) / 200_000
    density = np.exp((a - 1) * np.log(x) + (b - 1) * np.log1p(-x))
    return x[np.searchsorted(np.cumsum(density) / density.sum(), share)]


def test_beta_quantile(spark):
    from pyspark.sql import functions as F

    params = [(a, b) for a in (0.3, 1.2, 2.0, 5.0, 40.0, 300.0) for b in (0.3, 1.2, 2.0, 5.0, 40.0, 300.0)]
    df = spark.createDataFrame([(a, b, a / (a + b), float(a + b)) for a, b in params], "a double, b double, mean double, size double")
    for r in df.withColumn("low", url_filter.lower_bound(F.col("mean"), F.col("size"))).collect():
        exact = _quantile(r.a, r.b)
        assert r.low <= exact + 0.005 and (min(r.a, r.b) <= 1 or abs(r.low - exact) < 0.03), (r, exact)


def _below(x, a, b):
    """The share of a beta distribution below x, by summing the density of its log odds."""
    t, limit = np.linspace(-60 / a - 20, 60 / b + 20, 400_001), np.log(x / (1 - x))
    log = -a * np.logaddexp(0, -t) - b * np.logaddexp(0, t)
    density = np.exp(log - log.max())
    total = np.r_[0, np.cumsum((density[1:] + density[:-1]) / 2)]
    return np.interp(limit, t, total) / total[-1]


def test_small_parameters_have_true_quantiles(spark):
    from pyspark.sql import functions as F

    params = [(a, b) for a in (0.1, 0.3, 1.0, 1.2, 2.2, 30.0, 2000.0) for b in (0.1, 0.3, 1.0, 1.2, 2.2, 30.0, 2000.0)]
    rows = [(a, b, a / (a + b), a + b) for a, b in params] + [(0.0, 1.0, 0.0, 1.0), (1.0, 0.0, 1.0, 1.0), (None, None, None, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, mean double, size double")
    got = {(r.a, r.b): r.low for r in df.withColumn("low", url_filter.lower_bound(F.col("mean"), F.col("size"))).collect()}
    assert got.pop((0.0, 1.0)) == 0 and got.pop((1.0, 0.0)) == 1 and got.pop((None, None)) is None
    assert all(abs(_below(low, a, b) - 0.05) < 1e-5 for (a, b), low in got.items() if 1e-12 < low)
    assert abs(got[2.2, 0.1] - 0.722) < 0.001


def test_few_outcomes_under_bad_parents(spark):
    """Hosts with 0, 1 and 3 outcomes: the bound is the quantile of their posterior, which their parents' outcomes shape."""
    rows, bad = [], []
    for host, good_pages, bad_pages in [("a.worse.xyz", 0, 0), ("b.worse.xyz", 0, 1), ("c.worse.xyz", 3, 0), ("d.worse.xyz", 0, 3)] + [(f"h{k}.worse.xyz", 2, 38) for k in range(6)] + [(f"x{k}.fine.abc", 40, 2) for k in range(30)] + [("one.new.abc", 0, 1)]:
        for k in range(max(1, good_pages + bad_pages)):
            rows.append((len(rows), f"http://{host}/{k}"))
            if k < good_pages + bad_pages:
                bad.append((len(rows) - 1, int(k < bad_pages)))
    df, outcomes = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int")
    pages = df.select("page_id", url_filter.host_of(df.url).alias("site"))
    got = {r.site: r for r in url_filter.site_reputation(pages, outcomes).collect()}
    low = [got[f"{c}.worse.xyz"].bad_lower for c in "cabd"]
    assert low == sorted(low) and got["a.worse.xyz"].n == 0
    verdicts = {r.host: r.verdict for r in url_filter.judge_urls(df, outcomes, rules=()).collect()}
    assert all(v == ("block" if got[h].bad_lower > 1.5 * got[h].rate else "allow") for h, v in verdicts.items())
    assert verdicts["a.worse.xyz"] == verdicts["d.worse.xyz"] == "block" and verdicts["one.new.abc"] == "allow"


def test_parents_uncertainty_widens_priors(spark):
    """A host without outcomes under a domain with one outcome has a lower bound than under one with forty of the same rate."""
    df = spark.createDataFrame([(0.0, 0.0, 0.6, v) for v in (0.0, 0.01, 0.05)] + [(3.0, 6.0, 0.6, 0.0), (5.0, 6.0, 0.6, 0.0)], "bad double, n double, p double, p_var double")
    got = {r.p_var: r for r in url_filter._shrunk(df, "p", "q").filter("n = 0").collect()}
    assert got[0.0].q_size > got[0.01].q_size > got[0.05].q_size and all(abs(r.q - 0.6) < 1e-12 for r in got.values())
    assert got[0.05].q_var > got[0.0].q_var


def test_suffix_rules(spark, tmp_path):
    file = tmp_path / "suffixes.txt"
    file.write_text("// a comment\ncom\nuk\nco.uk\n*.ck\n!www.ck\n\nBlog.Example.com  // hosts\n*.nom.br\nbr\n")
    rules = url_filter.suffix_rules(spark, str(file))
    expected = {"a.b.com": "com", "x.co.uk": "co.uk", "x.uk": "uk", "me.blog.example.com": "blog.example.com", "a.b.ck": "b.ck", "www.ck": "ck", "q.www.ck": "ck", "x.y.nom.br": "y.nom.br", "localhost": "localhost", "a.unknown": "unknown", "10.0.0.1": "", "co.uk": "co.uk", ".".join("a" * 5000) + ".co.uk": "co.uk"}
    got = {r.site: r for r in url_filter.with_suffixes(spark.createDataFrame([(s,) for s in expected], "site string"), rules).withColumn("domain", url_filter.domain_of(url_filter.F.col("site"), url_filter.F.col("suffix"))).collect()}
    assert {s: r.suffix for s, r in got.items()} == expected
    assert [got[s].domain for s in ("a.b.com", "x.co.uk", "a.b.ck", "q.www.ck", "me.blog.example.com", "10.0.0.1", "co.uk")] == ["b.com", "x.co.uk", "a.b.ck", "www.ck", "me.blog.example.com", "10.0.0.1", "co.uk"]
    pages = spark.createDataFrame([(1, "http://a.b.ck/x"), (2, "http://" + "a." * 20_000 + "com/" + "p" * 100_000)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, spark.createDataFrame([(1, 0)], "page_id long, bad int"), suffixes=rules).collect()}
    assert got[2].rule == "com/" and len(got[2].host) == 40_003 and len(got[2].path) == 100_001 and got[1].verdict == "allow"


def test_reputation_blocks(spark):
    """A bad host, a bad domain and a bad suffix are blocked by the method alone, and unseen hosts with their parents."""
    rows, bad = [], []

    def pages(host, n, share, labelled=True):
        for k in range(n):
            rows.append((len(rows), f"http://{host}/p{k}"))
            if labelled:
                bad.append((len(rows) - 1, int(k < share * n)))

    for d in range(30):
        pages(f"www.good{d}.org", 20, 0.05)
    pages("www.good1.org:8080", 20, 0.05)
    pages("bad.mixed.org", 40, 0.95)
    pages("fine.mixed.org", 40, 0.05)
    for h in range(8):
        pages(f"h{h}.spam.co.uk", 20, 0.9)
        pages(f"h{h}.clean.co.uk", 20, 0.05)
        pages(f"shop{h}.zzz.", 30, 0.95)
        pages(f"10.0.0.{h}", 10, 0.05)
    pages("new.spam.co.uk", 1, 0, labelled=False)
    pages("new.clean.co.uk", 1, 0, labelled=False)
    pages("new.zzz", 1, 0, labelled=False)
    pages("user:pw@BAD.mixed.org:99", 1, 0, labelled=False)
    df, outcomes = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int")
    got = {}
    for r in url_filter.judge_urls(df, outcomes, rules=()).collect():
        got.setdefault(r.host, set()).add(r.verdict)
    blocked = {h for h, v in got.items() if v == {"block"}}
    expected = {"bad.mixed.org", "user:pw@bad.mixed.org:99", "new.zzz", "new.spam.co.uk"} | {f"h{h}.spam.co.uk" for h in range(8)} | {f"shop{h}.zzz." for h in range(8)}
    assert blocked == expected and all(v == {"allow"} for h, v in got.items() if h not in expected)


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, None, None), (5, 0, "user", "a<|im_end|>b"), (5, 0, "user", "a<|im_end|>b"), (None, 0, "user", "lost"), (6, None, "user", ""), (7, 0, "user", "hi"), (7, 1, "assistant", "no")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, k int")
    got = {r.conv_id: r for r in chat_format.render_conversations(turns).collect()}
    assert set(got) == {1, 4, 5, 6, 7, None} and got[1].n_copies == 2 and got[1].n_turns == 2
    assert got[1].rendered == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert got[5].rendered.count("< |im_end|>") == 2 and got[5].n_turns == 2
    assert chat_format.render_conversations(turns.filter("conv_id = 99")).count() == 0


def test_sentencepiece(docs, none):
    model = sentencepiece_codec.default_model()
    got = sentencepiece_codec.encode_texts(docs, model).collect()
    assert len(got) == len(ROWS) and all(r.parity and r.round_trip and r.decoded == (r.text or "") for r in got)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    assert sentencepiece_codec.encode_texts(none, model, verify=False).count() == 0
    codec = sentencepiece_codec.Codec(open(model, "rb").read(), 1)
    odd = ["  two  spaces ", "▁ mark", "\x00\x1f", "a" * 300, "<s></s><unk>"]
    lib = sentencepiece_codec._library(open(model, "rb").read()).encode(odd)
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(odd)] == lib


def test_token_store(docs, none, spark):
    from tokenizers import Tokenizer

    file = token_store.default_tokenizer()
    path = token_store.write_store(docs, new_path(spark, "store"), file, 1, by_word=True)
    tokenizer = Tokenizer.from_file(file)
    whole = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    assert Counter((r.doc_id, tuple(r.ids)) for r in token_store.read_documents(spark, path).collect()) == Counter((d, tuple(whole(t))) for d, t in ROWS)
    got = sorted(token_store.read_digests(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(d for d, _ in ROWS if d is not None)
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((d, zlib.crc32(np.array(whole(t), "<u4").tobytes())) for d, t in ROWS)
    assert token_store.read_digests(spark, token_store.write_store(none, new_path(spark, "store"), file)).count() == 0


def test_joined_crcs():
    rng = np.random.default_rng(2)
    strings = [[rng.bytes(n) for n in sizes] for sizes in ([], [5], [0, 7, 0], [1000, 1, 70_000, 3], [])]
    pieces = [p for s in strings for p in s]
    crcs, sizes = np.array([zlib.crc32(p) for p in pieces]), np.array([len(p) for p in pieces])
    got = token_store.joined_crcs(crcs, sizes, np.cumsum([len(s) for s in strings]))
    assert got.tolist() == [zlib.crc32(b"".join(s)) for s in strings]


def test_leaks(docs, none, spark):
    item = "what is the capital city of the old northern kingdom by the sea"
    edited = item.replace("capital", "main").replace("old", "very old")
    tests = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "zz"), (5, "never seen words stand here alone")], "item_id long, text string")
    rows = [(1, f"before {item} after"), (2, f"x y z {edited} end"), (3, "the old sea and the city"), (4, None), (5, ""), (6, "zz"), (7, item.upper()), (7, item.upper())]
    df = spark.createDataFrame([(d, t, 0.5) for d, t in rows], "doc_id long, text string, score double")
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(df, tests).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 4), (7, 1)} and got[1, 1].score == 1.0 and (got[1, 1].start_word, got[1, 1].end_word) == (1, 14)
    assert 0.6 < got[2, 1].score < 1
    assert sorted(r.doc_id for r in decontamination.without_leaks(df, tests).collect()) == [3, 4, 5]
    assert decontamination.find_leaks(docs, tests.limit(0)).count() == 0 and decontamination.find_leaks(none, tests).count() == 0
    assert decontamination.without_leaks(docs, tests.limit(0)).count() == len(ROWS)


def _smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 25))
        score, start, end = decontamination.align(a, b)
        assert score == _smith_waterman(a.tolist(), b.tolist())
        assert not score or decontamination.align(a, b[start:end])[0] == score
