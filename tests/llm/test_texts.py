"""Quality rules, tokens, coder, packing, BPE, HTML, toxicity and secrets: brute force, round trips, held-out accuracy."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import regex

from tabforge.llm import bpe_tree, html_tree, idcoder, packing, quality, secrets, tokens, toxicity
from tabforge.session import scratch_path

BYTES, WORDS = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("word_bpe_49k.json")
ODD = ["", " ", "\n", " a", "a ", "a  b", "a \n b", "don't we'll", "x<|endoftext|>y z", "naïve ΣΑΣ café", "１２ 3²", "\x1cx\x1f y", "tab\tand　wide", "a" * 3000, "the " * 2000, "é İI"]


def u4(ids):
    return np.array(ids, "<u4").tobytes()


# --- quality rules


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if seen[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    lost = 0
    for x in lines:
        n, symbols, bars = len(re.findall(r"[^\x20\x09-\x0D]+", x)), sum(c in quality.SYMBOLS for c in x), sum(c in quality.SEPARATORS for c in x)
        bad = symbols >= 3 and 10 * symbols > n or bars >= 3 and n <= 4 * bars or n >= 25 and not re.search(quality.SENTENCE_END, x) or len(x) <= 200 and bool(regex.search(quality.PHRASE, x.lower()))
        lost += len(x) * bad
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), failed, not failed and 2 * lost <= sum(map(len, lines)))


QUALITY = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_quality_matches_brute_force_and_sql(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: tuple(r[c] for c in QUALITY) for r in quality.judged(docs).collect()}
    assert got == {r.doc_id: brute_quality(r.text) for r in docs.collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert {r[0]: r[1:] for r in con.sql(quality.SQL).fetchall()} == got


def test_quality_edges(spark, edge_docs):
    odd = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, "a b c a b c a", "x | y | z | w\n" * 5, "All rights reserved.\n" + " ".join(f"plain{i} words. Go{i} on." for i in range(30)), "$1 #2 %3 & <x>"])], "doc_id long, text string")
    for df in (edge_docs, odd):
        rows = quality.judged(df).collect()
        assert [tuple(r[c] for c in QUALITY) for r in rows] == [brute_quality(r.text) for r in rows]
    boiler = [r for r in quality.judged(odd).collect() if (r.text or "").startswith("All rights")][0]
    assert boiler.kept and "reserved" not in boiler.cleaned
    assert quality.judged(edge_docs.limit(0)).count() == 0


def test_quality_spares_clean_lines(spark):
    inside = ["The design in this chapter is simple.", "They assign in order of age.", "A blog in English is fine.", "The dialog in act two is short.", "Every cookie was baked twice."]
    hindi = "यह एक लंबा वाक्य है जिसमें बहुत सारे शब्द हैं और यह बिना किसी और चिह्न के यहाँ तक चलता रहता है फिर समाप्त होता है।"
    prose = " ".join(" ".join(f"word{(i * 18 + j) * 7919 % 997}" for j in range(18)) + "." for i in range(45))
    wrapped = "\n".join(textwrap.wrap(prose, 70))
    texts = ["\n".join(f"{x} Number {i}." for i in range(4) for x in inside), "\n".join(f"{hindi} {i}।" for i in range(6)), wrapped]
    texts.append(wrapped + "\nPlease sign in.\nAll rights reserved\n")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(quality.judged(df).collect(), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in QUALITY) for r in rows] == [brute_quality(r.text) for r in rows]
    assert all(r.cleaned == r.text for r in rows[:3]) and rows[2].kept
    assert rows[3].cleaned == wrapped + "\n"


def test_quality_follows_the_labels(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [r for r in quality.query(spark, d).collect() if r.doc_id in labels]
    assert not [r.doc_id for r in rows if r.kept and labels[r.doc_id] == 0]
    assert not [r.doc_id for r in rows if not r.kept and not r.base_failed and labels[r.doc_id] == 1]


# --- token ids


def test_byte_bpe_is_the_library(small, spark):
    bpe = tokens.ByteBpe(BYTES)
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    assert bpe.encode_batch(texts) == [u4(bpe.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert bpe.encode(None) == b""


@pytest.mark.parametrize("n", [1, 63, 64, 129, 1000, 70_000])
@pytest.mark.parametrize("vocab", [1, 2, 50_257])
def test_blocks_round_trip(n, vocab):
    ids = np.random.default_rng(n).integers(0, vocab, n).astype(np.uint32)
    assert (idcoder.decode_block(idcoder.encode_block(ids, vocab), vocab) == ids).all()


def test_blocks_shrink_repeats_and_notice_damage():
    ids = np.tile(np.arange(500, dtype=np.uint32), 60)
    raw = idcoder.encode_block(ids, 50_257)
    assert len(raw) < len(ids)  # under half of two bytes an id
    broken = bytearray(raw)
    broken[len(raw) // 2] ^= 1
    with pytest.raises(ValueError):
        idcoder.decode_block(bytes(broken), 50_257)


def test_whole_block_of_real_ids_beats_its_order_0_entropy():
    """A whole block, as files hold them; a short block has its alphabet still to learn."""
    library, parts = tokens.byte_bpe(BYTES).tokenizer, []
    for rows in pq.ParquetFile("/root/testdata/sf0.1/documents.parquet").iter_batches(2000, columns=["text"]):
        texts = [x or "" for x in rows.column(0).to_pylist()]
        parts += [np.array([*e.ids, 0], np.uint32) for e in library.encode_batch(texts, add_special_tokens=False)]
        if sum(map(len, parts)) >= idcoder.BLOCK:
            break
    ids = np.concatenate(parts)[: idcoder.BLOCK]
    assert len(ids) == idcoder.BLOCK
    counts = np.unique(ids, return_counts=True)[1]
    entropy = -(counts * np.log2(counts / len(ids))).sum() / 8  # bytes, without what a frequency table would take
    raw = idcoder.encode_block(ids, library.get_vocab_size())
    assert len(raw) < entropy
    assert (idcoder.decode_block(raw, library.get_vocab_size()) == ids).all()


def id_rows(spark, docs, **options):
    folder = scratch_path(spark, "ids")
    return idcoder.documents(idcoder.write(docs, folder, BYTES, **options), folder).collect()


@pytest.mark.parametrize("options", [{}, {"file_bytes": 1 << 16}])
def test_id_files_round_trip(spark, small, options):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts, library, at = {r.doc_id: r.text for r in docs.collect()}, tokens.byte_bpe(BYTES).tokenizer, 0
    got = {r.doc_id: r for r in id_rows(spark, docs, **options)}
    for i in sorted(texts):
        ids = [*library.encode(texts[i], add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, bytes(got[i].ids)) == (at, len(ids), u4(ids))
        at += len(ids)


def test_id_files_edges(spark, edge_docs):
    rows = sorted(id_rows(spark, edge_docs), key=lambda r: r.start)
    assert len(rows) == edge_docs.count() and rows[0].doc_id is None
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert id_rows(spark, edge_docs.limit(0)) == []


# --- packing


def check_packing(spark, docs, window=2048):
    library = tokens.byte_bpe(BYTES).tokenizer
    want = Counter((r.doc_id, u4([*library.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in docs.collect())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, BYTES, 1, window).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= window
    padding = sum(window - n for n in (sum(x for _, x in p) for p in sequences.values()) if n & (n - 1))
    assert padding < window  # only the last window is padded
    for doc, parts in pieces.items():
        copies = [ids for (d, ids), n in want.items() if d == doc for _ in range(n)]
        assert sum(p.length for p in parts) == sum(len(i) // 4 for i in copies)
        for ids in set(copies):
            got = Counter((p.start, p.length, np.frombuffer(p.ids, "<u2").astype("<u4").tobytes()) for p in parts if p.doc_tokens == len(ids) // 4)
            assert all(ids[4 * s : 4 * (s + n)] == raw for s, n, raw in got)
            ends = sorted((s, s + n) for s, n, _ in got)
            assert ends[0][0] == 0 and ends[-1][1] == len(ids) // 4
    assert set(pieces) == {d for d, _ in want}


@pytest.mark.parametrize("window", [2048, 64])
def test_packing(spark, small, window):
    check_packing(spark, spark.read.parquet(f"{small}/documents.parquet"), window)


def test_packing_query_digests_the_same_pieces(spark, small):
    want = {(r.sequence_id, r.offset): (r.doc_id, r.start, r.length, r.doc_tokens, zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()))
            for r in packing.pack(spark.read.parquet(f"{small}/documents.parquet"), BYTES, 1).collect()}
    got = packing.query(spark, small).collect()
    assert {(r.sequence_id, r.offset): (r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_packing_edges(spark, edge_docs):
    check_packing(spark, edge_docs)
    assert packing.pack(edge_docs.limit(0), BYTES, 1).count() == 0


def test_packing_plan_fills_windows_from_complements():
    plan = packing.Plan({600: 100, 1448: 100, 1024: 7}, 2048)
    assert plan.windows == 103 and plan.residual == 1


# --- word BPE


def brute_merge(symbols, ranks):
    while True:
        pairs = [(ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not pairs:
            return symbols
        i = min(pairs)[1]
        symbols = [*symbols[:i], ranks[symbols[i], symbols[i + 1]][1], *symbols[i + 2 :]]


def test_segment_tree_merges_like_brute_force():
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in {(int(a), int(b)) for a, b in rng.integers(0, 30, (150, 2))}]
    made = [30 + i for i in range(len(pairs))]
    pairs += [(30 + i, int(rng.integers(0, 60))) for i in range(40)]
    made += [500 + i for i in range(40)]
    first = {}
    for r, (p, c) in enumerate(zip(pairs, made)):
        first.setdefault(p, (r, c))
    words = [rng.integers(0, 30, rng.integers(0, 70)).tolist() for _ in range(300)]
    got = bpe_tree.merge_words(np.array([s for w in words for s in w]), np.array([len(w) for w in words]), bpe_tree.Merges(pairs, made))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [brute_merge(w, first) for w in words]


def test_word_bpe_is_the_library(spark, small, edge_docs):
    from tokenizers import Tokenizer

    library, bpe = Tokenizer.from_file(WORDS), bpe_tree.word_bpe(WORDS)
    texts = ODD + [f"a{chr(c)}b {chr(c)}C" for c in (0x558, 0x85, 0xA0, 0x200B, 0x1C89, 0x113B1, 0x323C8, 0x1F600)] + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    for text, (ids, decoded) in zip(texts, bpe.encode_batch(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert (ids, decoded) == (u4(want), library.decode(want, skip_special_tokens=False)), text[:50]
    rows = bpe_tree.encoded(edge_docs, WORDS, digests=True).collect()
    assert len(rows) == edge_docs.count()
    assert {(r.n_tokens, r.ids_sha256) for r in rows if r.doc_id in (1, 2, 3)} == {(0, hashlib.sha256(b"").hexdigest())}
    assert bpe_tree.encoded(edge_docs.limit(0), WORDS).count() == 0


# --- HTML


def test_marginals_match_enumeration():
    page = html_tree.Page("<div class=ad><p>x y</p></div><article><h1>Title</h1><p>Some text. <a href=/>link</a></p></article>")
    unary, coupling = html_tree.model()
    n = len(page.parent)
    field = [sum(unary[i] for i in f) for f in page.features]
    total, mass = 0.0, np.zeros(n)
    for state in range(1 << n):
        y = [state >> i & 1 for i in range(n)]
        energy = sum(f * v for f, v in zip(field, y)) + sum(coupling[page.kind[page.parent[i]]] * (1 if y[i] == y[page.parent[i]] else -1) for i in range(1, n))
        total += np.exp(energy)
        mass += np.exp(energy) * np.array(y)
    assert np.allclose(html_tree.marginals(page, unary, coupling)[0], mass / total, atol=1e-9)


def test_held_out_layouts():
    unary, coupling = html_tree.model()
    wrong = total = 0
    for source in html_tree.labelled_pages(80, seed=123):
        page = html_tree.Page(source, labelled=True)
        p, _ = html_tree.marginals(page, unary, coupling)
        total += len(page.runs)
        wrong += sum((p[i] >= 0.5) != bool(page.label[i]) for i in page.runs)
    assert wrong < 0.04 * total


def test_pages(spark):
    import html

    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    for r in html_tree.query(spark, d).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        want = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", body)))).strip()
        assert (r.text, r.n_chars) == (want, len(want))


def test_page_edges(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>Plain &amp; simple&nbsp;text. <b>Bold</b>ly put.", "x"), (3, "u", "<script>never ends", "x"), (4, "u", "<!-- open", "x"), (5, "u", "<article><p>" + "Long text goes on. " * 50_000, "x"),
            (6, "u", "<main><p>One.</p><div hidden>no</div><form>no</form><p>Two.</main><section class=comments><p>Nice read, thanks a lot.</p></section>", "x"), (6, "u", "<article>" * 3000 + "deep text. It is kept.", "x")]
    got = html_tree.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r.text for r in got[:5]] == ["", "", "Plain & simple text. Boldly put.", "", ""]
    assert got[5].n_chars == 19 * 50_000 - 1 and got[6].text == "One. Two." and len(got) == len(rows)


@pytest.mark.parametrize("source,want", [
    ("<html><head><title>No</title><meta charset=utf-8><body><p>One.</p>", "One."),
    ("<head><title>No</title><link rel=x><p>One.</p>", "One."),
    ("<head><script>no</script> One. <p>Two.", "One.|Two."),
    ("<p>One.</p><select><option>no<option>no</select><p>Two.</p>", "One.|Two."),
    ("<p>One.</p><select><optgroup><option>no<optgroup><option>no</optgroup></select><p>Two.</p>", "One.|Two."),
    ("<p>One.</p><p hidden>no<p>Two.</p>", "One.|Two."),
    ("<ul><li hidden>no<ul><li>no</ul>no<li>One.</ul><p>Two.</p>", "One.|Two."),
    ("<ul><li>One.<li hidden>no</ul><p>Two.</p>", "One.|Two."),
    ("<table><tr hidden><td>no<td>no<tr><td>One.<tbody hidden><tr><td>no<tbody><tr><td>Two.</table><p>Three.</p>", "One.|Two.|Three."),
    ("<section><div hidden>no</section><p>One.</p>", "One."),
    ("<div hidden>no<div>no</div>no<section><div>no</div></section>no</div><p>One.</p>", "One."),
    ("<div>One.<button>no<button>no</button></div><p>Two.</p>", "One.|Two."),
    ("<p>One.</p><svg class=x /><p>Two.</p><svg><text>no</text></svg><p>Three.</p>", "One.|Two.|Three."),
])
def test_unclosed_dropped_elements_end(source, want):
    assert "|".join(html_tree.Page(source).runs.values()) == want


# --- toxicity


def test_composed_transducers():
    kinds = lambda text: [{"not": "N", "said": "R", "you": "Y", "idiot": "I", "kill": "T"}.get(w, "O") for w in text.split()]
    outcome = lambda text: [o for k, o in toxicity.outcomes(kinds(text)) if k in "IT"]
    assert outcome("what an idiot") == ["plain"]
    assert outcome("you are an idiot") == outcome("idiot that you are") == ["targeted"]
    assert outcome("you are not an idiot") == ["negated"]
    assert outcome("not a a a a idiot") == ["plain"]
    assert outcome("she said you idiot kill you") == ["reported", "reported"]


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.predicted) for r in toxicity.query(spark, d).collect() if r.held_out and r.doc_id in labels]
    counts = Counter(rows)
    assert counts[1, 1] >= 0.85 * (counts[1, 1] + counts[1, 0]) and counts[0, 1] <= 0.01 * (counts[0, 0] + counts[0, 1])


def test_toxicity_edges(spark, edge_docs):
    none = toxicity.fit(spark.createDataFrame([], "text string, toxic int"))
    rows = toxicity.scored(edge_docs, none).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert none.score("You are a worthless idiot and a clown.") > 0.5 > none.score("A fine day.")
    ids = spark.createDataFrame([(i,) for i in range(200)], "doc_id long")
    got = {r.doc_id: r.h for r in ids.select("doc_id", toxicity.held_out(ids.doc_id).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


# --- secrets


def test_secret_findings_held_out(spark):
    known = secrets.labelled_findings(spark, 6000).where(f"id >= {secrets.FINDINGS}")
    rows = secrets.judged(secrets.candidates(known, ["id"], "path")).join(known.select("id", "label"), "id").collect()
    assert len({r.id for r in rows}) == known.count()
    assert sum(r.is_secret == bool(r.label) for r in rows) >= 0.97 * len(rows)


def test_secrets_in_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    planted = re.compile(r'\bAKIA[0-9A-Z]{16}\b|(?i:password)=[0-9a-fA-F]{18}|(?i:token) = "[0-9a-fA-F]{40}"')
    want = {(i, m.start(), m.end() - m.start()) for i, t in texts.items() for m in planted.finditer(t)}
    assert {(r.doc_id, r.start, r.length) for r in secrets.scan(docs).collect() if r.is_secret} == want
    hidden = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert hidden == {i: planted.sub("[SECRET]", t) for i, t in texts.items()}


def test_secret_edges(spark, edge_docs):
    assert sorted(r.doc_id for r in secrets.scan(edge_docs).where("is_secret").collect()) == [4, 4]
    out = secrets.redacted(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert {r.text for r in out.where("doc_id = 4").collect()} == {"same text twice. [SECRET] ends it."}
    assert secrets.scan(edge_docs.limit(0)).count() == 0 and secrets.redacted(edge_docs.limit(0)).count() == 0


def test_long_assigned_secrets_are_whole(spark):
    long = hashlib.sha512(b"x").hexdigest() * 8
    long = long[:1000]
    jwt = f"eyJ{long[:40]}.{long[40:300]}.{long[300:343]}"
    found = [f"token={long}", f'token = "{long}"', f"token: '{long}'", f"token={jwt}", f'token="{jwt}"']
    docs = spark.createDataFrame([(i, f"set {x} and more.", "s") for i, x in enumerate(found)], "doc_id long, text string, source string")
    assert [(r.doc_id, r.start, r.found, r.is_secret) for r in secrets.scan(docs).orderBy("doc_id", "nth").collect()] == [(i, 4, x, True) for i, x in enumerate(found)]
    assert {r.text for r in secrets.redacted(docs).collect()} == {"set [SECRET] and more."}
    assert {r.value for r in secrets.scan(docs).collect()} == {long, jwt}


def test_secrets_under_any_name_and_encrypted_keys(spark):
    hexed, mixed = hashlib.sha1(b"x").hexdigest(), "h7Gt2kQz9LmXw4RbV8nYc3JdP6sFa1Ue"
    lines = "\n".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(300))
    key = lambda head: f"-----BEGIN RSA PRIVATE KEY-----\n{head}{lines}\n-----END RSA PRIVATE KEY-----"
    encrypted = key("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n")
    cases = [(f"SECRET_KEY={hexed}", f"SECRET_KEY={hexed}", hexed), (f"STRIPE_KEY={mixed}", f"KEY={mixed}", mixed), (f'TOKEN_PROD = "{mixed}"', f'TOKEN_PROD = "{mixed}"', mixed), (f"STRIPE={mixed}", mixed, mixed),
             (key(""), key(""), key("")), (encrypted, encrypted, encrypted), ("-----BEGIN PRIVATE KEY----- cut. " + encrypted, encrypted, encrypted)]
    docs = spark.createDataFrame([(i, f"set {c[0]} and more.", "s") for i, c in enumerate(cases)], "doc_id long, text string, source string")
    assert [(r.doc_id, r.found, r.value, r.is_secret) for r in secrets.scan(docs).orderBy("doc_id", "nth").collect()] == [(i, f, v, True) for i, (_, f, v) in enumerate(cases)]
    fine = ["sort_key=created_at", "foreign-key: customer_id", "https://example.org/?id=1234567890123456789012&utm=newsletter_2024_spring", "password-protected: documents", "public_key=placeholder"]
    assert not [r.found for r in secrets.scan(spark.createDataFrame([(1, t, "s") for t in fine], "doc_id long, text string, source string")).collect() if r.is_secret]


@pytest.mark.parametrize("source, want", [
    ('<body><div data-y="1"><p data-y=up>One.</p></div>', "One."),
    ('<p title="the hidden truth of it">One.</p><p>Two.</p>', "One.|Two."),
    ('<div class="md:block hidden lg:flex"><p>One.</p></div><p>Two.</p>', "One.|Two."),
    ('<p data-state=hidden>One.</p><p data-x="display:none">Two.</p>', "One.|Two."),
    ('<p hidden>One.</p><p style="color:red; display : none">Two.</p><p aria-hidden=true>Three.</p><p>Four.</p>', "Four."),
    ("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>", "If x=1 holds."),
    ("<object data=a.swf><p>Fallback.</p></object><p>Two.</p>", "Fallback.|Two."),
    ("<!--><p>One.</p><!---><p>Two.</p><!-- no --!><p>Three.</p><!-- a > b --><p>Four.</p>", "One.|Two.|Three.|Four."),
])
def test_attributes_and_comments_lose_no_text(source, want):
    assert "|".join(html_tree.Page(source).runs.values()) == want


def test_a_key_among_words_is_a_candidate(spark):
    key = "AKIA" + "Q7RT5UXW2ZB4CD6F"
    texts = [f'token: "Use {key} for the test account, then rotate it"', f"token = '{key} is the one'", f'token: "{key}"', 'password = "correct horse battery staple"']
    found = secrets.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id"]).collect()
    values = {r.doc_id: r.value for r in found}
    assert values == {0: key, 1: key, 2: key, 3: "correct horse battery staple"} and len(found) == 4


def test_bearer_tokens_and_passwords_in_addresses(spark):
    letters, mixed = "qZvTkWmXbRcLpNdGhJsFyHwBzQxKtVmR", "h7Gt2kQz9LmXw4RbV8nY"
    cases = [(f"Authorization: Bearer {letters}", f"Bearer {letters}", letters), (f"-H 'authorization: bearer {mixed}'", f"bearer {mixed}", mixed),
             (f"postgres://user:{mixed}@db.example.net/main", f"://user:{mixed}@", mixed), (f"redis://:{mixed}@cache", f"://:{mixed}@", mixed)]
    docs = spark.createDataFrame([(i, f"set {c[0]} and more.", "s") for i, c in enumerate(cases)], "doc_id long, text string, source string")
    assert [(r.doc_id, r.found, r.value, r.is_secret) for r in secrets.scan(docs).orderBy("doc_id", "nth").collect()] == [(i, f, v, True) for i, (_, f, v) in enumerate(cases)]
    hidden = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert hidden[2] == "set postgres[SECRET]db.example.net/main and more."
    fine = ["the bearer of good tidings", "Bearer your_access_token_here", "https://example.org:8080/a@b", "mail me: a://b c:d@e", "ftp://user:password@example.org"]
    assert not [r.found for r in secrets.scan(spark.createDataFrame([(1, t, "s") for t in fine], "doc_id long, text string, source string")).collect() if r.is_secret]
    whole = secrets.featured(secrets.candidates(spark.createDataFrame([(1, "token=" + "a" * 64 + "0123456789")], "doc_id long, text string"), ["doc_id"])).first()
    assert whole.f_alphabet == pytest.approx(11 / 74)   # of the whole value
