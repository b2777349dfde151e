"""Operators against brute force, with nulls, empty and repeated rows, empty tables and extra columns."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pytest

from medloom.llm import ann, bpe, chat, html, jaccard, lines, lm, mixing, queries, rules, subword
from medloom.llm.cluster import saved

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.001"
A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen"
ROWS = [
    (1, A, "en", "x"),
    (2, A.upper(), "en", "x"),
    (3, None, None, None),
    (4, "", "de", "y"),
    (5, "  \t\n ", "de", "y"),
    (6, "a b", "de", ""),
    (6, "a b", "de", ""),
    (None, "a b", "de", "z"),
    (8, A + "\n" + A + "\n" + "Überall ≠ straße " * 30, "de", "z"),
    (9, "x" * 5000 + " " + "w " * 3000, "en", "x"),
    (10, A.replace("ten", "zehn"), "en", "z"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    import pyspark.sql.functions as F

    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"size": F.lit("clash"), "n": F.lit(1), "h": F.lit(2), "n_chars": F.length("text")})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (9, 0), (None, 1), (8, None), (77, 0)], "doc_id bigint, quality int")


def test_mixing(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    total = {}
    for r in got:
        total.setdefault(r["source"], [r["target"], r["source_size"], 0])[2] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    weights = dict(zip(["", "x", "y", "z", None], [5, 2, 1, 5, 2]))
    target = {s: 0.0 for s in weights}
    free, rest = set(weights), float(sum(v[1] for v in total.values()))
    while True:  # cap, then give the excess back to the others
        level = rest / sum(weights[s] for s in free)
        over = [s for s in free if level * weights[s] > 3 * total[s][1]]
        for s in over or free:
            target[s] = 3.0 * total[s][1] if over else level * weights[s]
        if not over:
            break
        rest -= sum(target[s] for s in over)
        free -= set(over)
    for s, (t, size, taken) in total.items():
        assert t == pytest.approx(target[s]), s
        largest = max(r["size"] for r in got if r["source"] == s)
        assert abs(taken - t) <= largest, s
    assert mixing.mix(docs.limit(0)).count() == 0
    copies = mixing.sample(docs).groupBy("source").count().collect()
    assert {r["source"] for r in copies} <= set(weights)


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    path = queries.vocabulary_path()
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    hard = ["", "İI ΑΣ Σ", "<|endoftext|>a<|startoftext|", "don't WE'LL", "aaaaaaa 😂😂😂", "é É ﬁ\x1c\x85x", "漢字かな 한국 ١٢½", "#" * 500 + "x" * 3000]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(hard, 100)), "doc_id bigint, text string"))
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(frame, path), path).collect()}
    for doc_id, text in [*((r[0], r[1]) for r in ROWS), *enumerate(hard, 100)]:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[doc_id]["ids"], "<u4").tolist() == want
        assert got[doc_id]["text"] == library.decode(want, skip_special_tokens=False)
        assert got[doc_id]["n_tokens"] == len(want)
    assert bpe.digests(docs.limit(0), path).count() == 0


def _merge(symbols, ranks):
    while len(symbols) > 1:
        best = min(range(len(symbols) - 1), key=lambda i: (ranks.get((symbols[i], symbols[i + 1]), 1 << 30), i))
        if (symbols[best], symbols[best + 1]) not in ranks:
            break
        symbols = [*symbols[:best], symbols[best] + symbols[best + 1], *symbols[best + 2 :]]
    return symbols


@pytest.mark.parametrize("several_ways", [False, True])
def test_automaton_equals_merging(several_ways):
    rng = np.random.default_rng(int(several_ways))
    out_of_order = words = 0
    for _ in range(120):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(14):
            u, v = (tokens[rng.integers(len(tokens))] for _ in range(2))
            if u + v not in tokens or (several_ways and (u, v) not in merges):
                merges.append((u, v))
                tokens += [u + v] * (u + v not in tokens)
        vocab = {t: i for i, t in enumerate(tokens)}
        ranks = {m: i for i, m in enumerate(merges)}
        try:
            machine = bpe.Automaton(vocab, merges)
        except ValueError:
            out_of_order += 1
            continue
        for word in [*tokens, *("".join(rng.choice(list("abc"), rng.integers(1, 14))) for _ in range(60))]:
            words += 1
            assert [tokens[i] for i in machine.encode(word)] == _merge(list(word), ranks), (merges, word)
    assert out_of_order <= (3 if several_ways else 0) and words > 8_000


def test_automaton_leaves_out_tokens_that_merging_never_makes():
    pairs = [("a", "a"), ("aa", "a"), ("b", "a"), ("a", "aaa"), ("c", "ba"), ("aaa", "aaaa"), ("cba", "a"), ("ba", "aaa")]
    tokens = ["a", "b", "c", *(u + v for u, v in pairs)]
    machine = bpe.Automaton({t: i for i, t in enumerate(tokens)}, pairs)
    assert [tokens[i] for i in machine.encode("baaaa")] == ["b", "aa", "aa"]
    assert [tokens[i] for i in machine.encode("aaaa")] == ["aa", "aa"]
    with pytest.raises(ValueError, match="stands before"):
        bpe.Automaton({"a": 0, "b": 1, "c": 2, "ab": 3, "abc": 4}, [("ab", "c"), ("a", "b")])


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def test_jaccard(spark, docs):
    extra = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text")
    frame = docs.select("doc_id", "text").union(extra)
    rows = frame.collect()
    sets = {r["doc_id"]: _shingles(r["text"]) for r in rows if r["doc_id"] is not None}
    link = lambda x, y: x and y and 100 * len(x & y) >= 85 * len(x | y)
    want = _roots(sets, [(a, b) for a, b in combinations(sets, 2) if link(sets[a], sets[b])])
    got = jaccard.join(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        if r["doc_id"] is not None:
            assert r["n_shingles"] == len(sets[r["doc_id"]])
    assert jaccard.join(frame.limit(0)).count() == 0


def test_rules(spark, docs, labels):
    got = {r["doc_id"]: r for r in rules.apply(docs, rules.fit(docs, labels)).collect()}
    for doc_id, text, *_ in ROWS:
        text = text or ""
        w, r = WORD.findall(text), got[doc_id]
        filled = [x for x in text.split("\n") if WORD.search(x)]
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)} if len(grams) < 400 else None
        assert (r["n_words"], r["word_chars"]) == (len(w), sum(map(len, w)))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(filled) - len(set(filled))
        if hit is not None:
            assert r["n_repeat_words"] == len(hit)
        assert r["base_failed"] == (len(w) < 10 or 100 * r["n_repeat_words"] > 20 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert rules.apply(docs.limit(0), []).count() == 0
    rng = np.random.default_rng(1)
    x = {f: rng.random(600) for f in rules.FEATURES}
    low = (x["symbol_share"] > 0.8) | ((x["upper_share"] > 0.7) & (x["mean_word"] < 0.4))
    told = np.logical_or.reduce([r.holds(x) for r in rules.learn(x, low)])
    assert (told == low).mean() > 0.95
    assert rules.learn(x, np.zeros(600, bool)) == []


def test_chat(spark):
    hard = r"\### Assistant: </turn> ok"
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{hard}\n{t}") for t in range(101)]
    rows += [(2, None, None, None), (2, 0, "assistant", ""), (None, 0, "a: b\n", "x"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(frame)).collect()}
    for key in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[key]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[key]["n_turns"], got[key]["loss_chars"]) == (len(own), len(loss))
        assert got[key]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        whole = chat.turn_template([(r[2] or "", r[3] or "") for r in own])
        assert got[key]["formatted_chars"] == len(whole)
    assert chat.render(frame.limit(0)).count() == 0
    counted = lambda messages: f"{len(messages)} turns: " + chat.turn_template(messages)
    with pytest.raises(chat.RewritesHistory):
        list(chat.spans([("user", "a"), ("user", "b")], counted))


def test_templates_over_many_turns():
    turns = [("user" if t % 2 == 0 else "assistant", f"text {t}") for t in range(700)]
    marked = lambda messages: "<first>" * bool(messages) + chat.turn_template(messages)
    numbered = lambda messages: "".join(f"{n}: {chat.turn_template([m])}" for n, m in enumerate(messages))
    recent = lambda messages: chat.turn_template(messages[-40:])
    for template, count in ((marked, 700), (chat.turn_template, 700), (numbered, 200)):
        found = list(chat.spans(turns[:count], template))
        text = template(turns[:count])
        assert "".join(s.piece for s in found) == text
        for span, (_, said) in zip(found, turns):
            assert text[span.text_start : span.text_end] == said
            assert text[span.start : span.start + len(span.piece)] == span.piece
    assert len(list(chat.spans(turns[:40], recent))) == 40
    for template, count in ((recent, 80), (recent, 700), (numbered, 700)):
        with pytest.raises(chat.RewritesHistory):
            list(chat.spans(turns[:count], template))
    long = [("user", "x" * 100_000)] * 60  # very long texts: windows, same output
    assert "".join(s.piece for s in chat.spans(long, marked)) == marked(long)


def test_html(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/x>x</a></ul></nav>"
        "<div class='box'>Site slogan</div><header>H</header><article><h1>Head &amp; tail</h1><p><b>one{0}<br><p>two&nbsp; <i>in</i>line"
        "<div class='comments'><p>nice</div><form>f</form><script>x<1</script></article><footer>&copy;</footer></body>"
    )
    rows = [(k, "http://a.example/p", page.replace("{0}", f" {k}")) for k in range(5)]
    rows += [(9, None, None), (10, "http://b.example", ""), (11, "x", "<p>open <b>text &lt; &am"), (12, "x", "<article>cut <p>off</artic"), (12, "x", None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = html.main_text(frame).collect()
    assert len(got) == len(rows)
    text = {(r["page_id"], r["text"]) for r in got}
    assert all((k, f"Head & tail\none {k}\ntwo inline") in text for k in range(5))
    assert {(9, ""), (10, ""), (11, "open text < &am"), (12, "cut\noff"), (12, "")} <= text
    assert html.main_text(frame.limit(0)).count() == 0
    # recurring furniture without telling names, on pages without an article
    bare = "<div><div class='zz'>Slogan of the house</div><p>text {0}</p><p>shared words</p></div>"
    many = [(k, "http://c.example/p", bare.replace("{0}", str(k))) for k in range(8)]
    many += [(k, "http://d.example/p", bare.replace("{0}", str(k)).replace("shared words", f"own {k}")) for k in range(20, 22)]
    found = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(many, "page_id bigint, url string, html string")).collect()}
    assert found[3] == "text 3"
    assert found[20] == "Slogan of the house\ntext 20\nown 20"


def _edits(a, b):
    row = np.arange(len(b) + 1)
    other = np.frombuffer(b.encode("utf-32-le"), np.uint32)
    for i, c in enumerate(a, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (other != ord(c)))
        step = np.concatenate(([i], step))
        row = np.minimum.accumulate(step - np.arange(len(step))) + np.arange(len(step))
    return int(row[-1])


def test_lines(spark, docs):
    import pyspark.sql.functions as F

    base = "The quick brown foxes jumped above seventeen sleeping watchdogs during another thunderstorm near abandoned railway stations"
    more = [(k, base.replace("seventeen", f"number{k}") + "\nshort line\n" + f"own words of document {k} " + "q" * k, "en", "x") for k in range(50, 58)]
    extra = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text").limit(60)
    frame = saved(docs.select("doc_id", "text").union(spark.createDataFrame(more, SCHEMA).select("doc_id", "text")).union(extra))
    seen = lines.occurrences(frame).collect()
    texts = {}
    for r in frame.withColumn("rid", lines.row_id()).collect():
        if r["text"] is not None:
            for i, x in enumerate(r["text"].split("\n")):
                texts[r["rid"], i] = " ".join(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", x.lower()) if w)
    least = {r["h"]: [r[f"q{k // 4}"] >> 16 * (k % 4) & 0xFFFF for k in range(lines.MINIMA)] for r in seen if r["q0"] is not None}
    sketch = {r["h"]: (r["p0"] & (1 << 64) - 1, r["p1"] & (1 << 64) - 1, r["c"]) for r in seen if r["q0"] is not None}
    words = {r["h"]: texts[r["rid"], r["line_no"]] for r in seen}
    links = []
    for a, b in combinations(least, 2):
        same = [x == y for x, y in zip(least[a], least[b])]
        p, q = sketch[a], sketch[b]
        apart = max((x ^ y).bit_count() for x, y in zip(p[:2], q[:2]))
        if 4 * apart <= p[2] + q[2] and any(all(same[k] for k in band) for band in lines.BANDS[: 16 if max(len(words[a]), len(words[b])) < lines.LONG else lines.LONG_BANDS]):
            longer = max(len(words[a]), len(words[b]))
            if _edits(words[a], words[b]) <= longer * (100 - lines.SIMILARITY_PERCENT) // 100:
                links.append((a, b))
    sims = dict.fromkeys(r["h"] for r in seen)
    root = _roots(sims, links)
    assert links
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["rid"], r["line_no"])
    first = {}
    for r in sorted(seen, key=order):
        first.setdefault(root[r["h"]], (r["rid"], r["line_no"]))
    gone = {(r["rid"], r["line_no"]) for r in seen if first[root[r["h"]]] != (r["rid"], r["line_no"])}
    clash = {c: F.lit(1) for c in ("row", "gone", "_rid", "_gone", "h", "key", "root", "line_no", "n_lines", "k", "o")}
    got = lines.dedup(frame.withColumns(clash).withColumn("rid", lines.row_id())).collect()
    assert len(got) == frame.count()
    before = {(r["doc_id"], r["rid"]): r["text"] for r in frame.withColumn("rid", lines.row_id()).collect()}
    for r in got:
        old = before[r["doc_id"], r["rid"]]
        if old is None:
            assert (r["text"], r["n_lines"], r["n_dropped"]) == (None, 0, 0)
        else:
            kept = [x for i, x in enumerate(old.split("\n")) if (r["rid"], i) not in gone]
            assert (r["text"], r["n_dropped"]) == ("\n".join(kept), len(old.split("\n")) - len(kept))
    assert lines.dedup(frame.limit(0)).count() == 0


def test_ann(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0, None]), (None, [1.0] * 16), (20, x[20].tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.search(frame, "vec_id % 20 = 0").toPandas()
    assert sorted(got["query_id"].unique()) == list(range(0, 1500, 20))
    full, recall = x.astype(float), []
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        score = (full * full[q]).sum(axis=1)
        assert np.allclose(own["score"], score[own["vec_id"]], rtol=1e-12)
        assert own[["score", "vec_id"]].apply(tuple, axis=1).tolist() == sorted(zip(own["score"], own["vec_id"]), key=lambda t: (-t[0], t[1]))
        score[q] = -np.inf
        best = np.lexsort((np.arange(1500), -score))[:20]
        recall.append(len(set(best) & set(own["vec_id"])) / 20)
    assert np.mean(recall) >= 0.9
    assert ann.search(frame.limit(0), "vec_id % 20 = 0").count() == 0
    few = ann.search(frame.where("vec_id < 3"), "vec_id % 20 = 0").collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2)]


def test_language_model(spark, docs):
    got = lm.score(docs, share=1.0).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert (by[4]["n_words"], by[4]["pseudo_loglik"], by[4]["mean_loglik"]) == (0, 0.0, None)
    assert by[2]["n_words"] == 19 and by[2]["pseudo_loglik"] < 0
    of, within = lm.classes(lm.word_counts(docs))
    assert np.allclose([np.exp(within[of == c]).sum() for c in np.unique(of)], 1)
    p = lm._views(lm.train(docs, of, 1.0))
    data = np.frombuffer(A.encode(), np.uint8)
    tokens, first = lm._tokens(data, np.array([0, len(data)]))
    z = lm._forward(p, lm._contexts(tokens, first))[2]
    assert np.allclose(np.exp(z).sum(axis=1), 1, atol=1e-4)
    assert by[1]["pseudo_loglik"] == pytest.approx(float((z[np.arange(len(tokens)), of[tokens]] + within[tokens]).sum()), rel=1e-3)
    assert lm.score(docs.limit(0)).count() == 0


def test_training_lowers_loss():
    rng = np.random.default_rng(2)
    p = lm._views(lm.initial())
    context = rng.integers(0, 20, (512, 4))
    target = context[:, 1]
    loss = lambda: -lm._forward(p, context)[2][np.arange(512), target].mean()
    before = loss()
    for _ in range(200):
        lm.train_step(p, context, target, 0.2)
    assert loss() < before / 2


def test_subword(spark, docs, labels):
    got = subword.classify(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert subword.classify(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in subword.classify(docs, labels.limit(0)).collect()} == {0.5}
    sf = DATA.replace("0.001", "0.01")
    known = spark.read.parquet(f"{sf}/labels.parquet")
    rows = subword.classify(spark.read.parquet(f"{sf}/documents.parquet"), known).join(known, "doc_id").where("held_out").toPandas()
    assert (rows["predicted"] == rows["quality"]).mean() > 0.9


def _dropped(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r["n_dropped"] for r in lines.dedup(frame).collect()}


def test_lines_find_changed_words(spark):
    """Pairs with one of n words (two of 20, five of 50) changed, by edit similarity alone."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7))
    texts = []
    for n, changed in ((6, 1), (8, 1), (10, 1), (15, 1), (20, 1), (30, 1), (20, 2), (50, 5)):
        for _ in range(40):
            x = [word() for _ in range(n)]
            y = list(x)
            for at in rng.choice(n, changed, replace=False):
                y[at] = word()
            assert _edits(" ".join(x), " ".join(y)) <= 0.2 * (8 * n - 1)
            texts += [" ".join(x), " ".join(y)]
    got = _dropped(spark, texts)
    assert not any(got[k] for k in range(0, len(texts), 2))
    found = np.array([got[k] for k in range(1, len(texts), 2)]).reshape(8, 40).mean(axis=1)
    assert found.min() >= 0.9 and found.mean() >= 0.98, found


def test_short_lines(spark):
    """Exact repeats of short lines go; a script without spaces is compared by character n-grams."""
    han = "".join(chr(0x4E00 + 37 * k) for k in range(60))
    other = "".join(chr(0x6E00 + 41 * k) for k in range(60))
    got = _dropped(spark, ["Read more", "read  more!", "Read mode", han, han[:30] + "X" + han[31:], other, "...", "..."])
    assert got == {0: 0, 1: 1, 2: 0, 3: 0, 4: 1, 5: 0, 6: 0, 7: 0}


def test_html_copied_articles(spark):
    """Articles under several urls of a host stay whole; what half of the host's pages share goes, and so do links."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(12))
    menu = "<div class='zz'><a href=/a>A</a> <a href=/b>B</a></div>"
    quote = "<div class='box'><p>boxed words <a href=/q>from here</a></p></div><ul><li>first point<li>second point</ul>"
    whole = lambda k: f"{menu}<div class='content'><h2>Title {k}</h2><p>{words(k)}</p><div>bare {k}<br>text</div></div>"
    inner = lambda k: f"<article><div class='content'>{menu}<p>{words(k)}</p>{quote}</div></article>"
    rows = [(k, "http://e.example/p", whole(k // 3) + " " * k) for k in range(9)]
    rows += [(20 + k, "http://f.example/p", inner(k // 3) + " " * k) for k in range(9)]
    found = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(9):
        assert found[k] == f"Title {k // 3}\n{words(k // 3)}\nbare {k // 3} text"
        assert found[20 + k] == f"{words(k // 3)}\nboxed words from here\nfirst point\nsecond point"
