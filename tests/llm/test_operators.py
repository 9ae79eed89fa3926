"""Training-data operators against brute force, round trips and defined edge cases."""

import random
import zlib

import numpy as np
import pytest
import xxhash

from tidemark.llm import (chat_format, embedding_join, exact_dedup, html_text, packing, secret_scan,
                          sentencepiece_codec, simhash, toxicity, url_filter)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empties, ties, repeated rows, near copies, a secret."""
    base = " ".join(f"word{k % 37} and{k % 11}" for k in range(120))
    rows = [(0, None), (1, ""), (2, "a"), (3, "a"), (3, "a"), (None, "a"), (4, base), (5, base + " tail"),
            (6, base.replace("word3 ", "other ")), (7, "x " * 5000), (8, 'token = "' + "0a1b" * 10 + '" end'),
            (9, "été 的 \U0001f600 <|endoftext|> don't")]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def _components(ids, links):
    label = {i: i for i in ids}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_exact_dedup_edges(spark, docs):
    for slots in (2, 1024):  # with and without frequent digests
        rows = exact_dedup.exact_dedup(spark, docs, slots=slots).collect()
        a = [r for r in rows if r.group_size == 4]
        assert len(rows) == 12 and len(a) == 4 and all(r.keep_id == 3 for r in a)
        assert sum(r.kept for r in a) == 1 and sum(r.kept for r in rows) == 8
        empty = [r for r in rows if r.doc_id in (0, 1)]
        assert {r.keep_id for r in empty} == {1} and sum(r.kept for r in empty) == 1
        kept = exact_dedup.drop_exact_copies(spark, docs, slots=slots)
        assert kept.columns == docs.columns and kept.count() == 8
    assert exact_dedup.exact_dedup(spark, docs.limit(0)).count() == 0


def test_simhash_against_pairs(spark, docs):
    rows = simhash.simhash_components(spark, docs).collect()
    assert len(rows) == 12
    prints = {}
    for r in rows:
        if r.id is not None:
            prints[r.id] = r.fp & (2 ** 64 - 1)
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = _components(prints, links)
    assert all(r.component_id == want[r.id] for r in rows if r.id is not None)
    h = xxhash.xxh64_intdigest(b"a", 42)
    assert prints[2] == h and prints[0] == prints[1] == 0
    assert simhash.drop_near_copies(spark, docs).columns == docs.columns
    assert simhash.simhash_components(spark, docs.limit(0)).count() == 0


def test_near_copies_leave_one_row_of_each_component(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=3000)) for _ in range(7)]
    near = texts[0] + " " + words[0]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3]),
            (7, near), (None, near), (8, texts[0]), (None, texts[4]), (4, texts[4]), (9, None), (9, ""), (9, texts[5]),
            (None, texts[6])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(5)
    prints = [simhash.fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = {}
    for k, root in _components(range(len(rows)), links).items():
        groups.setdefault(root, []).append(rows[k])
    assert len(groups) == 8
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")
    want = sorted((min(g, key=order) for g in groups.values()), key=order)
    got = [(r.doc_id, r.text) for r in simhash.drop_near_copies(spark, docs).collect()]
    assert sorted(got, key=order) == want


def test_bit_sliced_distances_are_exact():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    a[1::2] = a[::2] ^ np.uint64(0b10000010000000001)
    q, lane = simhash.near_lanes(a[:99], simhash.bit_planes(a), len(a), 3)
    want = np.nonzero(np.bitwise_count(a[:99, None] ^ a[None, :]) <= 3)
    assert set(zip(q.tolist(), lane.tolist())) == set(zip(*(w.tolist() for w in want)))


def test_hot_bucket_is_tiled(spark):
    prints = spark.range(300).selectExpr("(id * 1048576) AS fp")
    links = simhash.link_forest(spark, prints, tile=32).collect()
    want = _components(range(300), [(a, b) for a in range(300) for b in range(a) if (a ^ b).bit_count() <= 3])
    got = _components(range(300), [(r.a >> 20, r.b >> 20) for r in links])
    assert got == want


def test_embedding_links_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(12, 8))[rng.integers(0, 12, 300)] + rng.normal(size=(300, 8)) * 0.3
    v[50:90] = v[50]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] + [1.0] * 7), (904, [])]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + odd,
                               "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_join.embedding_links(spark, df).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = _components(range(300), list(zip(*(x.tolist() for x in np.nonzero(near)))))
    assert all(got[i].n_links == near[i].sum() and got[i].component_id == want[i] for i in range(300))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd)
    assert embedding_join.embedding_links(spark, df.limit(0)).count() == 0


def _fitted(spark, texts, labels):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return toxicity.fit_toxicity(docs, spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"))


def test_chain_marginals_and_tagging(spark):
    rng = np.random.default_rng(1)
    emit, first = rng.normal(size=60), rng.random(60) < 0.2
    first[0] = True
    start, trans = np.array([0.7, 0.3]), np.array([[0.8, 0.2], [0.4, 0.6]])
    got = toxicity.marginals(emit, first, start, trans)[0]
    bounds = [*np.nonzero(first)[0].tolist(), 60]
    for low, high in zip(bounds[:-1], bounds[1:]):
        gains = [np.array([1, np.exp(e)]) for e in emit[low:high]]
        ahead = [start * gains[0]]
        for g in gains[1:]:
            ahead.append(ahead[-1] @ trans * g)
        back = [np.ones(2)]
        for g in gains[:0:-1]:
            back.insert(0, trans @ (g * back[0]))
        want = [(a * b)[1] / (a * b).sum() for a, b in zip(ahead, back)]
        assert np.allclose(got[low:high], want)
    random.seed(5)
    words = ["".join(random.choices("abcdefgh", k=6)) for _ in range(80)]
    calm = [" ".join(random.choices(words, k=12)) for _ in range(200)]
    rude = [" ".join([*random.choices(words, k=9), "scumbag", *random.choices(words, k=2)]) for _ in range(40)]
    model = _fitted(spark, calm + rude, [0] * 200 + [1] * 40)
    lexicon = toxicity.Lexicon(model.known)
    rude = " ".join([*words[:2], "scumbag", *words[2:4]])
    calm = " ".join(words[4:9])
    score, p = toxicity.score_chains(model, lexicon, [[lexicon[w] for w in t.split()] for t in (rude, calm)])
    assert score[0] > 0.7 > 0.3 > score[1] and p[2] > 0.5 and (p[5:] < 0.5).all()
    assert [(s["start"], s["end"]) for s in toxicity._spans(rude, p[:5])] == [(14, 21)]


def test_toxicity_without_labels_or_text(spark, docs):
    model = _fitted(spark, [], [])
    rows = toxicity.score_toxicity(docs.withColumnRenamed("lang", "toxicity"), model).collect()
    assert len(rows) == 12 and all(r.toxicity < 0.7 and r.toxic_spans == [] for r in rows)


def test_packing_is_whole_and_gapless(spark, docs):
    from tokenizers import Tokenizer
    import public_tokenizers
    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = packing.pack(spark, docs).collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    for text in {r.text for r in docs.collect() if r.doc_id in (7, 9)}:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want = {(k // 2048, zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)}
        assert want <= {(r.piece, r.ids_crc32) for r in rows}
    counts = np.bincount(np.random.default_rng(0).integers(1, 2049, 5000), minlength=2049)
    used = np.zeros(2049, int)
    for combination, times in packing.pack_histogram(counts).plan:
        assert sum(k * a for k, a in combination.items()) <= 2048
        for k, a in combination.items():
            used[k] += a * times
    assert (used == counts).all()
    assert packing.pack(spark, docs.limit(0)).count() == 0


def test_secrets_are_found_and_masked(spark, docs):
    found = secret_scan.scan_secrets(spark, docs).collect()
    assert [(r.id, r.start, r.length, r.is_secret) for r in found if r.is_secret] == [(8, 9, 40, True)]
    clean = {r.doc_id: r for r in secret_scan.redact(spark, docs).collect()}
    assert clean[8].text == 'token = "[REDACTED]" end' and clean[8].n_chars == len(clean[8].text)
    assert clean[0].text is None and clean[9].text.endswith("don't")
    assert secret_scan.scan_secrets(spark, docs.limit(0)).count() == 0


_FORMS = [("password: {}.", "Tr0ub4dor&3"), ("passwd={}", "Hx7!kd9"), ("db password: {} here", "s3cr3tpw99"),
          ("at postgres://u:{}@db/x", "pw1234"), ("password = '{}'", "hunter2"), ('token = "{}"', "short123"),
          ("API_KEY={}", "9f86d081884c7d659a2feaa0c55ad015"), ('{{"api-key"   :\n  "{}"}}', "a b1 c2"),
          ("url = 'https://x.org/?token={}&page=2'", "ab12cd"), ("url=\"redis://:{}@h:6379\"", "pw:1@2"),
          ("aws_2_secret_access_key_1={}", "Zx81/kd0+q=="), ("pwd => {}, end", "été9"),
          ("https://{}@git.example.com/x", "ghp4a8b1c9d2e7f6a5b4")]


def test_usual_forms_of_secrets_are_found(spark):
    rows = [(k, form.format(value), "en", "s", 0) for k, (form, value) in enumerate(_FORMS)]
    calm = [(100, "the secret: usual words, ssh://git@example.com and a compass: 12345 north", "en", "s", 0)]
    usual = [(200 + k, "usual words and calm prose", "en", "s", 0) for k in range(25)]
    docs = spark.createDataFrame(rows + calm + usual, DOCS)
    found = [r for r in secret_scan.scan_secrets(spark, docs).collect() if r.is_secret]
    assert {r.id: r.value for r in found} == {k: value for k, (_, value) in enumerate(_FORMS)}
    assert all(rows[r.id][1][r.start:r.start + r.length] == r.value for r in found)
    clean = {r.doc_id: r.text for r in secret_scan.redact(spark, docs).collect()}
    assert [clean[k] for k in range(len(_FORMS))] == [form.format("[REDACTED]") for form, _ in _FORMS]
    assert clean[100] == calm[0][1]


def test_url_rules_and_mined_rules(spark):
    urls = [None, "no scheme", "HTTP://WWW.Example.com/en/1", "http://a.example.com/en/", "http://x.net/es/9",
            "http://x.net/de/9?q=1#t", "http://com", "ftp://spam.casino.org/win/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    planted = spark.createDataFrame([(["host=casino", "path=win", f"host=h{k % 5}"], 1) for k in range(60)]
                                    + [(["path=win", f"host=h{k % 5}"], 0) for k in range(200)],
                                    "tokens array<string>, label int")
    got = {r.page_id: r for r in url_filter.judge_urls(spark, pages, url_filter.mine_rules(planted)).collect()}
    assert [got[k].rule for k in range(8)] == [None, None, "www.example.com/en/", "example.com/en/", "net/es/",
                                              None, None, None]
    assert [got[k].verdict for k in range(8)] == ["allow", "allow", "allow", "block", "block", "allow", "allow",
                                                 "block"]
    assert got[5].path == "/de/9" and got[6].host == "com" and got[6].path == ""


def test_url_labels_come_by_the_document_in_the_path(spark, workdir):
    ends = ["", "/", ".html", "?page=2", "#top", "/?utm=1"]
    pages = [(k, f"https://{'casino' if k % 3 == 0 else 'news'}.org/en/{5000 - k}{ends[k % 6]}") for k in range(90)]
    pages += [(900, None), (901, "https://news.org/en/99999999999999999999"), (902, "https://casino.org/about")]
    labels = [(5000 - k, int(k % 3 > 0), 0) for k in range(90)] + [(k, 1, 0) for k in range(90)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{workdir}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{workdir}/labels.parquet")
    got = {r.page_id: r.verdict for r in url_filter.op7_url_filter(spark, workdir).collect()}
    assert got == {k: "block" if "casino" in (url or "") else "allow" for k, url in pages}


def test_chat_round_trip(spark):
    random.seed(2)
    bits = ["</s>", "[INST]", " [/INST]", "\\", "\\\\</s>", "<<SYS>> ", "hello", " ", "[ROLE]", "[/TURN]", "\n"]
    for _ in range(500):
        role = random.choice(["user", "assistant", "system", "", "tool", "</s>x"])
        text = "".join(random.choices(bits, k=random.randrange(7)))
        assert chat_format.parse(chat_format.render_turn(role, text)[0]) == [(role, text)]
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x</s>"), (None, 0, None, "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    assert got[1].n_turns == 2 and got[1].loss_chars == 5 and got[None].n_turns == 1
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).count() == 0


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<script>if(a<b){}", ""), ("a < b", "a < b"),
    ("<nav>menu one</nav><article><h1>T &amp; t</h1><p>One  two<p>three <b>x</article><footer>f</footer>",
     "T & t\nOne two\nthree x"),
    ("<div class=post><p>Four five six.</p><p>7</p><div class='comment-list'><p>a reader says</p></div></div>",
     "Four five six.\n7"), ("<div>" * 3000 + "deep", "deep")])
def test_html_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("attrs", [
    "style='overflow:hidden'", 'title="a hidden gem"', "data-hidden=false", "data-id='share' aria-label='class=ad'",
    "title='5\" hidden role=menu'", "data-class=ad x-role=search", "class='' class=ad"])
def test_html_attributes_are_read_whole(attrs):
    assert html_text.main_text(f"<div {attrs}><article><p>One two.</p></article></div>") == "One two."
    assert html_text.main_text(f"<body><article><p>A.</p></article><p class=ad hidden {attrs}>B") == "A."


@pytest.mark.parametrize("href", ['"/hidden-cove"', "/hidden-cove", "'/p?id=share'", "/p?id=share"])
def test_html_link_words_stay(href):
    assert html_text.main_text(f"<article><p>One <a href={href}>two</a> three.</p></article>") == "One two three."


_LONG = "<p>One two three four five six.</p>"


@pytest.mark.parametrize("wrapper", [
    "div class='layout has-sidebar'", "div class=no-comments", "div class=with-header", "div id=search-results",
    "form action=/", "div class=widget", "div class='ad sidebar'", "fieldset", "div role=search", "header"])
def test_html_wrapper_of_the_article_stays(wrapper):
    end = wrapper.split()[0]
    for article in ("article", "main"):
        page = (f"<body><nav>menu</nav><{wrapper}><{article}>{_LONG}</{article}><button>go</button>"
                f"<label>name</label></{end}><footer>f</footer>")
        assert html_text.main_text(page) == "One two three four five six."
    if wrapper != "header":
        page = f"<body><{wrapper}><div>{_LONG}{_LONG}</div><select><option>x</select></{end}><p>end</p>"
        assert html_text.main_text(page).startswith("One two three four five six.\nOne two")


@pytest.mark.parametrize("beside", [
    "<div class=related><article>teaser of more text</article></div>", "<div class='site-header'>t</div>",
    "<ol class=comment-list><li class=comment><article class=comment-body>a reader says much more text here"
    "</article></ol>", "<div class='ad-300x250 ad-slot'>buy</div>", "<form>sign up</form>",
    "<div id=comments><p>a reader says more than the whole article, and more</p></div>", "<aside>x</aside>"])
def test_html_parts_beside_the_article_go(beside):
    assert html_text.main_text(f"<body><article>{_LONG}{beside}</article>") == "One two three four five six."
    assert html_text.main_text(f"<body><article>{_LONG}</article>{beside}") == "One two three four five six."


def test_sentencepiece_equals_the_library():
    import public_tokenizers
    codec = sentencepiece_codec.Codec(public_tokenizers.path(sentencepiece_codec.MODEL))
    random.seed(4)
    texts = ["", "  a  b ", "a" * 300, "日本語" * 50, "<s> <0x0A>\n\U0001f600"]
    texts += ["".join(random.choices("etaonr é.,=_()12", k=200)) for _ in range(20)]
    for by_word in (True, False):
        codec.by_word = by_word
        for text in texts:
            ids = codec.encode(text)
            assert np.frombuffer(ids, "<u4").tolist() == codec.model.encode(text)
            assert codec.decode(ids) == text


def test_unigram_pass_against_all_segmentations():
    codec = object.__new__(sentencepiece_codec.Codec)
    rng = random.Random(11)
    words = {"".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(14)} | {"a", "b"}
    ids = {w: k for k, w in enumerate(sorted(words))}
    codec._prepare(ids, {k: rng.uniform(-9, -1) for k in ids.values()}, False)

    def best(text):
        sums = {0: 0.0}
        for end in range(1, len(text) + 1):
            sums[end] = max(sums[s] + codec.by_piece[text[s:end]] for s in range(end) if text[s:end] in ids)
        return sums[len(text)]

    for size in (0, 1, 2, 7, 60, 500):
        text = "".join(rng.choices("ab", k=size))
        pieces = list(codec.segments(text))
        assert "".join(pieces) == text
        assert abs(sum(codec.by_piece[p] for p in pieces) - best(text)) < 1e-6


def test_word_ids_are_the_tokenizers():
    """Words of every kind: Latin letters and marks by parts, all others as they are."""
    public = pytest.importorskip("public_tokenizers")
    words = packing.WordIds(public.path(packing.TOKENIZER))
    rng = random.Random(3)
    latin = [chr(c) for c in range(0x250)] + list(".,;:!?'abcXYZ") * 20
    wide = [chr(c) for c in range(0x600)] + list("ΣσςẞKΩ가漢́̈­😀　 ") * 20
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for pool in (latin, wide) for _ in range(5000)]
    made += ["İstanbul", "it's", "we'LL", "<|endoftext|>", "x<|startoftext|>y", "a" * 60, "՘c", "naïve!!"]
    whole = words.whole.encode_batch(made, add_special_tokens=False)
    for text, want in zip(made, whole, strict=True):
        got = b"".join(words[w] for w in packing._words(text))
        assert np.frombuffer(got, "<u4").tolist() == want.ids, repr(text)
