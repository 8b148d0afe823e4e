"""Operators 1, 3, 4, 6 and 7."""

import hashlib
import re
from html import unescape

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threshmill.llm import chat, html, mixing, shared, syncmers, toxicity
from threshmill.llm.queries import QUERIES

# --- 1


def test_pages_against_their_article(spark, sf_dir):
    pages = {r.page_id: r for r in QUERIES["op1_html"](spark, sf_dir).collect()}
    for r in shared.table(spark, sf_dir, "pages").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]+>", " ", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article))
        text = "\n".join(b for b in blocks if b)
        assert (pages[r.page_id].text, pages[r.page_id].n_chars) == (text, len(text))


PROSE = "Plain sentences of an article that go on for a while, so that a block of text comes to be. "


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>unclosed <b>bold &amp; &lt;b&gt;", "unclosed bold & <b>"),
        (f"<header>Site</header><div><h1>T</h1><p>{PROSE}</p><ul><li>a<li>b &nbsp; c</ul></div><div class='comments'><p>{PROSE}</div><footer>f</footer>", f"T\n{PROSE.strip()}\na\nb c"),
        (f"<article><header><h1>T</h1></header><p>{PROSE}</p><aside>{PROSE}</aside><form>x</form><p>end</p></article><p>{PROSE}", f"T\n{PROSE.strip()}\nend"),
        (f"<main><p>{PROSE}</p><div class='cookie-notice'>we use</div><script>if (a<b) '</p>'</script><p hidden>h</p></main><nav>menu</nav>", PROSE.strip()),
        ("<article><p>one</p><!-- <p>no</p> --><p>two</p>", "one\ntwo"),
    ],
)
def test_page(page, text):
    assert html.extract(page) == text


LINKS = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(5))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h1><a href=x>Title</a></h1><p>text</p></article>", "Title\ntext"),
        (f"<article><p>text</p><ul>{LINKS}</ul><p>end</p></article>", "text\n" + "\n".join(f"link {i}" for i in range(5)) + "\nend"),
        (f"<main><p>text</p><table><tr><td><a href=x>a</a></td></tr><tr><td><a href=y>b</a></td></tr></table><nav>{LINKS}</nav></main>", "text\na\nb"),
        ("<div class='layout has-sidebar'><article><p>text</p></article></div>", "text"),
        ("<section id='with-comments'><article><p>text</p></article><div class='comments'><article>c</article></div></section>", "text"),
        ("<div class='content-sidebar-wrap'><main><p>text</p></main><div class='sidebar'><article>other</article></div></div>", "text"),
        ("<div class='sidebar-layout'><div class='sidebar'><article>other</article></div><article><p>text</p></article></div>", "text"),
        (f"<div><p>{PROSE}</p></div><div class='comments'><article>{PROSE * 3}</article></div><div class='sidebar'><article>other</article></div>", PROSE.strip()),
        ("<main><p>text</p></main><div class='related'><article>other</article></div><div hidden><main>no</main></div>", "text"),
    ],
)
def test_whole_article(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<p data-id='comment'>{PROSE}</p>", PROSE.strip()),
        (f"<p data-class=ad aria-label='hidden menu' title='id=ad'>{PROSE}</p>", PROSE.strip()),
        (f"<div class='story related-work'><p>{PROSE}</p><p>and so on</p></div>", f"{PROSE.strip()}\nand so on"),
        (f"<div id='notice-board-news'><p>{PROSE}</p></div><p>short</p>", f"{PROSE.strip()}\nshort"),
        (f"<div class='comments'><p>{PROSE}</p></div>", ""),
        (f"<div class='story'><p>{PROSE}</p></div><div class='related'><p>{PROSE * 9}</p></div>", PROSE.strip()),
        (f"<p>{PROSE}</p><p class='x>no end of the quote</p>", f"{PROSE.strip()}\nno end of the quote"),
        (f"<p>{PROSE} 1 <b 2", f"{PROSE.strip()} 1 <b 2"),
        (f"<p>{PROSE}<![CDATA[a < b]]></p>", f"{PROSE.strip()} a < b"),
    ],
)
def test_page_without_marks(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><h1>T</h1><p>{PROSE}</p><ul>{LINKS}</ul></article>", f"T\n{PROSE.strip()}"),
        (f"<article><ul>{LINKS}</ul><p>{PROSE}</p><p>{PROSE}</p><div>{LINKS}</div></article>", f"{PROSE.strip()}\n{PROSE.strip()}"),
        (f"<main><p>{PROSE}</p><ul>{LINKS}</ul><p>short</p><ul>{LINKS}</ul></main>", "\n".join([PROSE.strip(), *(f"link {i}" for i in range(5)), "short"])),
    ],
)
def test_link_blocks_of_marked_articles(page, text):
    """The windows decide inside a mark too: all lines inside it are more than the text."""
    assert html.extract(page) == text
    inside = [line for line, _, *marks in html.lines_of(page) if line and any(marks)]
    assert inside != text.split("\n")


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<p>{PROSE}</p><p>{PROSE}</p>" + "<div><a href=x>Read more on other sites</a></div>" * 4, f"{PROSE.strip()}\n{PROSE.strip()}"),
        (f"<p>{PROSE}</p>" + "<div><a href=x>link</a></div>" * 3 + f"<p>{PROSE}</p>", f"{PROSE.strip()}\n{PROSE.strip()}"),
        (f"<p>{PROSE}</p>" + "<div><a href=x>link</a></div>" * 2 + f"<p>{PROSE}</p>", f"{PROSE.strip()}\nlink\nlink\n{PROSE.strip()}"),
    ],
)
def test_link_runs_stay_or_go_as_one(page, text):
    assert html.extract(page) == text


def test_distribution_finds_articles_without_marks(spark, sf_dir):
    """Pages whose articles are plain div elements give the same text, but for a few with hardly any."""
    pages = [r.html for r in shared.table(spark, sf_dir, "pages").collect()]
    plain = [re.sub(r"<(/?)(?:article|main)\b", r"<\1div", p) for p in pages]
    differ = [a for a, b in zip(map(html.extract, pages), map(html.extract, plain)) if a != b]
    assert len(differ) <= 0.03 * len(pages)


@pytest.mark.parametrize("piece", ["<a b", '<p x="', "<b><p></p>", "<div class=ad><article>", "</span><div>", "<!--", "<a x='\">", "<", "<script>", "&amp"])
def test_pages_are_read_in_linear_time(piece):
    import time

    def took(n):
        began = time.process_time()
        html.extract(piece * n)
        return time.process_time() - began

    assert took(20_000) < 20 * took(2_000) + 0.5


def test_pages_of_odd_tables(spark):
    rows = [(1, "u", f"<p>{PROSE}", "c", 7), (1, "u", f"<p>{PROSE}", "c", 7), (None, None, None, None, None), (2, "u", "", "c", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = html.with_main_text(pages)
    assert sorted(out.columns) == sorted(pages.columns)
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out.collect()) == [(0, "", 0), *[(1, PROSE.strip(), len(PROSE.strip()))] * 2, (2, "", 0)]
    assert html.with_main_text(pages.filter("false")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/!-pabdiv =\"'&;xn\n", max_size=80))
def test_broken_markup_ends(text):
    html.extract(text)


# --- 3


def test_chat_query(spark, sf_dir):
    got = {r.conv_id: r for r in QUERIES["op3_chat"](spark, sf_dir).collect()}
    rows = {}
    for r in shared.table(spark, sf_dir, "conversations").collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    rows[-7] = [(0, "user", chat.PLANTED), (1, "assistant", chat.PLANTED)]
    assert set(got) == set(rows)
    for conv, own in rows.items():
        own.sort()
        loss = "".join(t for _, r, t in own if r == "assistant")
        turns = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), turns, len(loss), hashlib.sha256(loss.encode()).hexdigest())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "odd: role\\"]), st.text(alphabet="ab#<>/turn\\: \n", max_size=20)), max_size=6))
def test_template_is_reversible(turns):
    output, rewrites, spans, loss = chat.render(turns, chat.turn_template)
    assert not rewrites and chat.parse_turns(output) == turns
    assert "".join(output[a : a + n] for a, n in spans) == output
    assert [chat.unescape(output[a : a + n]) for a, n in loss] == [t for r, t in turns if r == "assistant"]


def test_rewriting_template_is_seen():
    rewriting = lambda turns: "".join(f"[{r}]{t}" if i == len(turns) - 1 else f"[{r}]{t.strip('x')}" for i, (r, t) in enumerate(turns))
    assert chat.render([("user", "x"), ("assistant", "b")], rewriting)[1]
    assert not chat.render([("user", "a"), ("assistant", "b")], rewriting)[1]


def test_long_and_odd_conversations(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(20)] + [(None, 0, None, None), (2, None, "assistant", ""), (2, None, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("clash"))
    short, whole = (chat.digests(chat.format_conversations(turns, block_turns=n)) for n in (7, 256))
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert key(short) == key(whole)
    assert {(r.conv_id, r.n_turns) for r in short.collect()} == {(1, 20), (2, 2), (None, 1)}
    assert chat.digests(chat.format_conversations(turns.filter("false"))).count() == 0


def test_rewriting_across_a_block_border_is_seen(spark):
    def last_marked(turns):  # the turn before the last loses its mark
        return "".join(f"{'*' if i == len(turns) - 1 else ''}{t}|" for i, (_, t) in enumerate(turns))

    def every_eighth(turns):  # each eighth turn takes a character from the one before
        return "".join(t[:-1] if (i + 2) % 8 == 0 and i + 1 < len(turns) else t for i, (_, t) in enumerate(turns))

    turns = spark.createDataFrame([(1, i, "user", f"turn {i:02d}") for i in range(40)], "conv_id long, turn long, role string, text string")
    for template in (last_marked, every_eighth):
        assert all(r.rewrites for r in chat.format_conversations(turns, template, block_turns=20).collect())
    own = [("user", f"turn {i}") for i in range(9)]
    output, rewrites, spans, _ = chat.render(own[8:], every_eighth, history=own[:8])
    assert not rewrites and output == "turn 8" and spans == [(0, 6)]
    assert chat.render(own[7:8], every_eighth, history=own[:7])[1]  # the border's own turn is rewritten


# --- 4


def expected_anchors(text):
    """A plain version on token indices: places of closed syncmers, by the same hashes from Spark."""
    return re.findall(rf"\S{{1,{syncmers.PIECE}}}", text)


def test_closed_syncmers_by_brute_force(spark):
    text = " ".join(f"w{i * i % 97}x{i}" for i in range(120))
    tokens = expected_anchors(text)
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(tokens, tokens[1:]))], "i int, a string, b string")
    inner = [r.h for r in frame.orderBy("i").select(F.xxhash64("a", "b").alias("h")).collect()]
    w = syncmers.WINDOW
    places = [i for i in range(len(inner) - w + 1) if min(inner[i : i + w]) in (inner[i], inner[i + w - 1])]
    found = spark.createDataFrame([(text,)], "t string").select(syncmers.anchors(F.col("t")).alias("a")).first().a
    assert [x.position for x in found] == places


def test_syncmers_move_with_their_text(spark):
    core = " ".join(f"word{i * 7 % 53} other{i}" for i in range(100))
    a, b = core, "entirely new head words stand here " + core
    row = spark.createDataFrame([(a, b)], "a string, b string").select(syncmers.match_offset(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).alias("o"), syncmers.likeness(syncmers.sketch(F.col("a")), syncmers.sketch(F.col("b"))).alias("s")).first()
    assert row.o == len(expected_anchors(b)) - len(expected_anchors(a)) and row.s > 0.8


def test_fingerprint_query(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op4_syncmers"](spark, sf_dir).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in shared.table(spark, sf_dir, "documents").collect())
    prints, worse = {}, 0
    for i, (doc, text) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        g = got[doc]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256((text[: len(text) - half] + other[:half]).encode()).hexdigest())
        assert prints.setdefault(text, g.fingerprint) == g.fingerprint and 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
        worse += text != other and g.near_edited <= g.near_next
    assert worse <= 0.02 * len(rows)


@pytest.mark.parametrize("ids", [[5, None, 1, 1, 9, 200], [None, None, None], [7], [-(1 << 63), (1 << 63) - 1, 0, *range(40), 1 << 61], [3] * 60 + [1, 2, 4, 5] * 3])
def test_next_rows_of_odd_identifiers(spark, monkeypatch, ids):
    monkeypatch.setattr(syncmers, "RUN_SAMPLE", 2)
    rows = [(i, None if n % 5 == 4 else f"text {n // 2}", "c", "d") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run string, followed string").withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    order = [r.text for r in df.orderBy(F.col("doc_id").asc_nulls_first(), "tie").collect()]
    out = syncmers.with_next(df, "doc_id", "tie", ["text"])
    assert out.columns == [*df.columns, "next_text"]
    assert sorted((str(r.text), str(r.next_text)) for r in out.collect()) == sorted((str(a), str(b)) for a, b in zip(order, order[1:] + order[:1]))
    assert syncmers.with_next(df.filter("false"), "doc_id", "tie", ["text"]).count() == 0


def test_runs_are_even(spark):
    """Clustered, wide and frequent identifiers alike fill runs evenly."""
    ids = [*range(3000), 1 << 61, *[77] * 3000]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "doc_id long, n long").withColumn("tie", F.xxhash64("n"))
    cuts = syncmers.run_cuts(df, "doc_id", 32)
    sizes = [r["count"] for r in df.groupBy(syncmers.run_of(F.col("doc_id"), F.col("tie"), cuts)).count().collect()]
    assert len(sizes) >= 20 and max(sizes) < 4 * len(ids) / 32


# --- 6


def test_toxicity_on_held_out_rows(spark):
    """Toxic texts show words of the lexicon, or invented ones that only the labelled rows tell of."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(3, 9)))
    bad = [*toxicity.LEXICON["insult"][:4], "zwarkel", "zwarkels", "quomphy", "vlistren"]
    rows, labels = [], []
    for i in range(1200):
        words, toxic = [word() for _ in range(40)], i % 8 == 0
        for _ in range(3 * toxic):
            words[int(rng.integers(0, 40))] = str(rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic) if i % 3 else None))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + labels[:5], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, known)).collect()}
    import zlib

    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    held = [r for r in out.values() if r.held_out]
    assert np.mean([r.predicted for r in held if r.doc_id % 8 == 0]) >= 0.95
    assert np.mean([r.predicted for r in held if r.doc_id % 8]) <= 0.02
    assert all(r.predicted == (r.score >= 0.3) for r in out.values())
    changed = [(i, 1 - y if out[i].held_out and y is not None else y) for i, y in labels]  # held-out labels are not learned from
    again = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame(changed, "doc_id long, toxic int"))).collect()
    assert all(abs(r.score - out[r.doc_id].score) < 1e-9 for r in again)


def test_label_model_by_brute_force():
    """EM in plain loops over rows gives the same rates, weights and posteriors as sums over counted votes."""
    import math
    from collections import Counter

    rng = np.random.default_rng(4)
    v, anchors, corpus = 4, 40, 300
    votes = (rng.random((anchors, v)) < 0.3).astype(np.uint8)
    gold = rng.integers(-1, 2, anchors)
    others = (rng.random((corpus, v)) < 0.25).astype(np.uint8)
    counted = Counter(map(tuple, others.tolist()))
    kinds, n = np.array(list(counted), float), np.array(list(counted.values()), float)
    found = toxicity.label_model(votes, gold, lambda m: m.sums(kinds, n), rounds=3)

    first = toxicity.first_model(votes.astype(float), gold)
    prior, rates, weight = first.prior, first.rates.tolist(), first.weight.tolist()

    def posterior(row, g):
        logit = math.log(prior / (1 - prior)) + (0 if g < 0 else toxicity.ANCHOR if g == 1 else -toxicity.ANCHOR)
        for j in range(v):
            a, b = (rates[1][j], rates[0][j]) if row[j] else (1 - rates[1][j], 1 - rates[0][j])
            logit += weight[j] * math.log(a / b)
        return 1 / (1 + math.exp(-max(-30, min(30, logit))))

    rows = [(r, g, 1.0) for r, g in zip(votes.tolist(), gold.tolist())] + [(r, -1, anchors / corpus) for r in others.tolist()]
    for _ in range(3):
        toxic = [posterior(r, g) for r, g, _ in rows]
        size = [sum(w * (q if y else 1 - q) for q, (_, _, w) in zip(toxic, rows)) for y in (0, 1)]
        fired = [[sum(w * (q if y else 1 - q) * r[j] for q, (r, _, w) in zip(toxic, rows)) for j in range(v)] for y in (0, 1)]
        residual = [[r[j] - q * rates[1][j] - (1 - q) * rates[0][j] for j in range(v)] for q, (r, _, _) in zip(toxic, rows)]
        product = [[sum(w * e[i] * e[j] for e, (_, _, w) in zip(residual, rows)) / sum(size) for j in range(v)] for i in range(v)]
        rates = [[(fired[y][j] + (0.5 if y else 0.05)) / (size[y] + 1) for j in range(v)] for y in (0, 1)]
        weight = [1 / max(1, sum(abs(product[i][j]) / math.sqrt(product[i][i] * product[j][j]) for j in range(v))) for i in range(v)]
        prior = min(0.5, max(0.005, size[1] / sum(size)))
    assert np.allclose(found.rates, rates, atol=1e-6) and np.allclose(found.weight, weight, atol=1e-5) and abs(found.prior - prior) < 1e-9
    assert np.allclose(found.posterior(votes.astype(float), gold), [posterior(r, g) for r, g in zip(votes.tolist(), gold.tolist())], atol=1e-5)


def test_features_by_brute_force():
    names = ["idiot", "trash", "zork*", "zo*", "ab"]
    text = "Idiot idiots, zorkling zork TRASH zoo ab abc; you idiot! Shut up"
    words = re.findall(r"[^\W\d_]+", text.lower())
    counts = [sum(w == n if not n.endswith("*") else w.startswith(n[:-1]) and len(w) >= len(n) for w in words) for n in names]
    x = toxicity.row_of(text, toxicity.Patterns(names))
    assert x[: len(names)].tolist() == [min(3, c) / 3 for c in counts]
    sentences = [bool(p.search(text)) for p in toxicity.SENTENCES.values()]
    assert x[len(names) : -2].tolist() == sentences and any(sentences)
    assert x[-2] == pytest.approx(min(1, np.log1p(sum(counts)) / 3)) and x[-1] == pytest.approx(min(1, 400 * sum(counts) / (len(text) + 200) / 8))
    assert not toxicity.row_of("", toxicity.Patterns(names)).any()


def test_votes_are_counted_over_all_documents(spark):
    rows = [(i, t) for i, t in enumerate(["an idiot", "an idiot", "trash", "plain", None, "", "you are an idiot"])]
    names = [w for words in toxicity.LEXICON.values() for w in words]
    counted = toxicity.count_votes(spark.createDataFrame(rows, "doc_id long, text string"), names).collect()
    patterns = toxicity.Patterns(names)
    wanted = {}
    for _, t in rows:
        key = np.packbits(toxicity.votes_of(toxicity.row_of(t or "", patterns)[None, :])[0]).tobytes()
        wanted[key] = wanted.get(key, 0) + 1
    assert {bytes(r.votes): r.n for r in counted} == wanted


def test_label_model_weighs_correlated_voters_down():
    rng = np.random.default_rng(1)
    y = rng.random(2000) < 0.3
    one = rng.random((2000, 2)) < np.where(y[:, None], 0.8, 0.05)
    votes = np.hstack([one, one[:, :1], one[:, :1]])
    gold = np.where(rng.random(2000) < 0.2, y, -1)
    model = toxicity.label_model(votes, gold)
    assert model.weight[0] < 0.5 < model.weight[1]
    assert ((model.posterior(votes.astype(float), gold) > 0.5) == y).mean() > 0.85


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "you are an idiot"), (4, "plain words")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([(7, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()}
    assert got[1] == got[2] == got[4] < toxicity.THRESHOLD <= got[None]
    assert toxicity.score(docs.filter("false"), toxicity.train(docs.filter("false"), none)).count() == 0


def test_sentences_without_listed_words(spark):
    texts = ["plain words", "nobody likes you", "shut up", "go die", "please kill yourself"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    for known in (labels, labels.filter("false")):
        got = {r.text: r.score for r in toxicity.score(docs, toxicity.train(docs, known)).collect()}
        assert all(got["plain words"] < toxicity.THRESHOLD <= got[t] for t in texts[1:]), got


# --- 7


def test_raking_hits_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 1000))) for i in range(4) for j in range(3) for k in range(2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    wanted = {"source": [0.1, 0.2, 0.3, 0.4], "lang": [0.5, 0.3, 0.2], "topic": [0.7, 0.3]}
    targets = {d: spark.createDataFrame([(f"{d[0]}{i}", s) for i, s in enumerate(v)], "value string, share double") for d, v in wanted.items()}
    got = mixing.rake(cells, targets).collect()
    w = np.array([float(r[3]) for r in rows]).reshape(4, 3, 2)
    total = w.sum()
    for _ in range(200):
        for axes, share in (((1, 2), wanted["source"]), ((0, 2), wanted["lang"]), ((0, 1), wanted["topic"])):
            w *= np.expand_dims(np.array(share) * total / w.sum(axes), axes)
    for r in got:
        assert r.raked == pytest.approx(w[int(r.source[1]), int(r.lang[1]), int(r.topic[1])], rel=1e-4)


def test_raking_is_close(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 1000) ** 2)) for i in range(4) for j in range(3) for k in range(2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    got = mixing.rake(cells).collect()
    total = sum(r[3] for r in rows)
    for d, power in mixing.POWERS.items():
        own = {}
        for r in got:
            own.setdefault(r[d], [0, 0.0])
            own[r[d]] = [own[r[d]][0] + r.tokens, own[r[d]][1] + r.raked]
        wanted = {v: (n / total) ** power for v, (n, _) in own.items()}
        for v, (_, raked) in own.items():
            assert raked / total == pytest.approx(wanted[v] / sum(wanted.values()), rel=2e-7)


def test_tokens_and_topics(spark):
    rows = [("a\tb\rc\fd\x0be", 5, "prose"), ("  one\n\n\n    two   three ", 3, "prose"), (" \n", 0, "prose"), ("", 0, "prose"), ("one\xa0word", 1, "prose")]
    rows += [("the microphone and the telephone", 5, "prose"), ("see you @ noon", 4, "prose"), ("write to a.b@c.org", 3, "contact"), ("call +1 (234) 567-8901", 4, "contact")]
    rows += [("it was a secret password", 5, "prose"), ('password = "x"', 3, "code"), ("<b>x</b>", 1, "code"), ("Licensed to you", 3, "legal"), ("sublicenser", 1, "prose"), ("x | y | z", 5, "table")]
    df = spark.createDataFrame([r[:1] for r in rows], "text string")
    got = df.select("text", mixing.n_tokens(F.col("text")).alias("n"), mixing.topic_of(F.col("text")).alias("topic")).collect()
    assert [tuple(r) for r in got] == rows


def test_mixing_query_by_brute_force(spark, sf_dir):
    """Topics, tokens, raking, calibration and sampling of the whole query, in plain loops."""
    docs = shared.table(spark, sf_dir, "documents").collect()
    low = lambda t: t.lower()

    def topic(t):
        for name, (pattern, strings) in mixing.TOPICS.items():
            if any(x in low(t) for x in strings) and re.search(pattern, t):
                return name
        return "prose"

    own = {r.doc_id: (r.source, r.lang, topic(r.text or ""), len(re.findall(r"[^ \t\n\x0B\f\r]+", r.text or ""))) for r in docs}
    tokens = {}
    for *cell, n in own.values():
        tokens[tuple(cell)] = tokens.get(tuple(cell), 0) + n
    total, raked = sum(tokens.values()), {c: float(n) for c, n in tokens.items()}
    shares = []
    for axis, d in enumerate(mixing.DIMENSIONS):
        part = {}
        for c, n in tokens.items():
            part[c[axis]] = part.get(c[axis], 0) + n
        power = {v: (n / total) ** mixing.POWERS[d] for v, n in part.items() if n}
        shares.append({v: p / sum(power.values()) * total for v, p in power.items()})
    for _ in range(300):
        for axis, wanted in enumerate(shares):
            sums = {}
            for c, w in raked.items():
                sums[c[axis]] = sums.get(c[axis], 0) + w
            raked = {c: w * wanted[c[axis]] / sums[c[axis]] if w else w for c, w in raked.items()}
    factor = {c: raked[c] / n if n else 1.0 for c, n in tokens.items()}
    at, upto = 0.0, 1e6  # the scale by bisection
    for _ in range(200):
        scale = (at + upto) / 2
        expected = sum(n * min(1.0, scale * factor[c]) for c, n in tokens.items())
        at, upto = (scale, upto) if expected < mixing.KEEP_SHARE * total else (at, scale)
    got = {r.doc_id: r for r in QUERIES["op7_mixing"](spark, sf_dir).collect()}
    assert set(got) == set(own) and {r.kept for r in got.values()} == {True, False}
    for i, (*cell, n) in own.items():
        probability = min(1.0, scale * factor[tuple(cell)])
        number = int(hashlib.md5(f"{mixing.SEED}/{i}".encode()).hexdigest()[:13], 16) / 2**52
        r = got[i]
        assert (r.source, r.lang, r.topic, r.n_tokens) == (*cell, n)
        assert r.factor == pytest.approx(factor[tuple(cell)], abs=2e-5) and r.probability == pytest.approx(probability, abs=2e-5)
        assert abs(number - probability) < 1e-4 or r.kept == (number < probability)


def test_raking_warns_of_contradicting_targets(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "y", "t", 10)], "source string, lang string, topic string, tokens long")
    targets = {d: spark.createDataFrame(rows, "value string, share double") for d, rows in (("source", [("a", 0.9), ("b", 0.1)]), ("lang", [("x", 0.1), ("y", 0.9)]))}
    with pytest.warns(UserWarning, match="marginals off"):
        assert mixing.rake(cells, targets, rounds=3).count() == 2


def test_mixing_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, "s"), (1, None, None, "s"), (2, "a b c", "en", None), (None, "", "en", "s")], "doc_id long, text string, lang string, source string").withColumn("topic", F.lit("clash"))
    rows = mixing.mixed(docs).collect()
    assert len(rows) == 4 and len({r.mix_kept for r in rows if r.doc_id == 1}) == 1 and {r.topic for r in rows} == {'clash'}
    assert mixing.mixed(docs.filter("false")).count() == 0
