"""Row-wise operators: licences, quality counts, encoders and HTML, against plain versions."""

from __future__ import annotations

import hashlib
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from offerledger.llm import html_extraction, html_training, license_scan, orc_tokens, quality_rules, sentencepiece_agenda, shared
from tests.llm import cases


def base_licences(text: str) -> tuple:
    words = cases.ALNUM.findall((text or "").translate(cases.LOWER))
    places, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        here = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences(spark):
    rows = license_scan.op1_license_scan(spark, cases.SF).collect()
    texts = cases.texts(spark)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_licences(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert ("gpl-3" in r.labels.split(",")) == ("GNU General Public License, version 3" in texts[r.doc_id])


def test_licence_templates_need_their_key_phrases(spark):
    docs = {1: "x Licensed under the GNU Affero General Public License, version 3.", 2: "under the mit license the mit license under THE MIT License", 3: "Licensed under CC BY-SA 4.0", 4: "permission is hereby granted free of charge to any person obtaining a copy of this program and associated documentation files", 5: "granted under version 3 of nothing"}
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["agpl-3", "mit", "cc-by-sa", "mit", ""]
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 0, 7) and got[5].score == 0
    odd = license_scan.scan_licenses(cases.odd_documents(spark)).collect()
    assert len(odd) == 12 and all(r.labels == "" for r in odd)
    assert license_scan.scan_licenses(cases.empty_documents(spark)).count() == 0


def test_every_notice_of_a_document_is_found(spark):
    """Two notices of words that are rare in the corpus leave the places of a third, whose words are frequent."""
    notice = {label: text for label, text, _ in license_scan.TEMPLATES}
    mit = license_scan.TEMPLATES[1][1]
    docs = [(1, " x ".join([notice["bsd"], mit, notice["gpl-3"], notice["cc-by-sa"]]))]
    docs += [(10 + i, "this work is licensed under the gnu general public license version 3") for i in range(30)]
    docs += [(50 + i, f"in the version of this work and the license with no use to any {i}") for i in range(30)]
    docs.append((100, " y ".join(text for _, text, _ in license_scan.TEMPLATES)))
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string").repartition(1)).collect()}
    assert got[1] == "bsd,cc-by-sa,gpl-3,mit"
    assert got[100] == ",".join(sorted({label for label, _, _ in license_scan.TEMPLATES}))
    assert all(got[i] == ("gpl-3" if i < 50 else "") for i in got if 10 <= i < 100)


def counts(text: str) -> tuple:
    words, seen, dup = cases.WHITE.findall(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if cases.WHITE.search(line):
            dup += line in seen
            seen.add(line)
    at: dict = {}
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {j for ks in at.values() if len(ks) > 1 for k in ks for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality_counts(spark):
    for docs in (cases.documents(spark), cases.odd_documents(spark)):
        texts = docs.select("doc_id", "text").collect()
        got = sorted(tuple(r[c] for c in ("doc_id", *quality_rules.COUNTS, "base_failed")) for r in quality_rules.quality_rules(docs, cases.labels(spark), 5).collect() if r.doc_id is not None)
        want = [(t.doc_id, *(c := counts(t.text)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for t in texts if t.doc_id is not None]
        assert got == sorted(want)


def test_piece_codec(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_agenda.MODEL))
    for docs in (cases.documents(spark), cases.odd_documents(spark)):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
        got = [tuple(r)[:4] for r in sentencepiece_agenda.piece_codec(docs, public_tokenizers.path(sentencepiece_agenda.MODEL)).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sentencepiece_agenda.piece_codec(cases.empty_documents(spark), public_tokenizers.path(sentencepiece_agenda.MODEL)).count() == 0


def test_orc_tokens(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(orc_tokens.VOCABULARY))
    want, start = [], 0
    for i, text in sorted(cases.texts(spark).items()):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, orc_tokens.END_ID]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in orc_tokens.op10_orc_tokens(spark, cases.SF).collect()) == want


def test_orc_files_skip_and_hold_odd_rows(spark, tmp_path):
    folder, path = str(tmp_path / "t"), public_tokenizers.path(orc_tokens.VOCABULARY)
    docs = cases.odd_documents(spark)
    orc_tokens.write_tokens(docs, folder, path)
    tokenizer = Tokenizer.from_file(path)
    want = sorted((r.doc_id is not None, r.doc_id or 0, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + (0,)) for r in docs.select("doc_id", "text").collect())
    got = sorted((r.doc_id is not None, r.doc_id or 0, tuple(r.ids)) for r in orc_tokens.read_tokens(spark, folder).collect())
    assert got == want
    index = sorted((tuple(r) for r in orc_tokens.token_index(spark, folder).collect()), key=lambda r: r[1])
    assert [r[1] for r in index] == [0, *np.cumsum([r[2] for r in index])[:-1].tolist()]
    assert [r[0] for r in index] == sorted((r[0] for r in index), key=lambda x: -1 if x is None else x)
    plan = orc_tokens.read_tokens(spark, folder).where("doc_id = 6")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,6)]" in plan
    orc_tokens.write_tokens(cases.empty_documents(spark), folder + "e", path)
    assert orc_tokens.token_index(spark, folder + "e").count() == 0


def test_orc_files_have_indexes_and_are_skipped(spark, tmp_path):
    """Row indexes and Bloom filters of doc_id stand in the stripes, integers are run-length encoded, and a look-up reads one row group."""
    folder = str(tmp_path / "many")
    docs = spark.range(25_000).selectExpr("2 * id as doc_id", "concat('text ', id % 7) as text")
    orc_tokens.write_tokens(docs.coalesce(1), folder, public_tokenizers.path(orc_tokens.VOCABULARY))
    orc, conf = spark._jvm.org.apache.orc, spark._jsc.hadoopConfiguration()
    rows = 0
    for part in (tmp_path / "many").glob("part-*.orc"):
        reader = orc.OrcFile.createReader(spark._jvm.org.apache.hadoop.fs.Path(str(part)), orc.OrcFile.readerOptions(conf))
        rows += reader.getNumberOfRows()
        footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
        kinds = {(s.getColumn(), str(s.getKind())) for s in footer.getStreamsList()}
        assert (1, "ROW_INDEX") in kinds and (1, "BLOOM_FILTER_UTF8") in kinds and (2, "BLOOM_FILTER_UTF8") not in kinds
        assert str(footer.getColumns(1).getKind()) == "DIRECT_V2"
    assert rows == 25_000

    def read(where: str) -> tuple[int, int]:
        """Rows returned, and rows that came out of the scan."""
        df = orc_tokens.read_tokens(spark, folder).where(where).select("doc_id", "n_tokens")
        n, plan = len(df.collect()), df._jdf.queryExecution().executedPlan()
        plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
        return n, plan.collectLeaves().head().metrics().get("numOutputRows").get().value()

    assert read("doc_id >= 0") == (25_000, 25_000)
    n, scanned = read("doc_id = 30000")
    assert n == 1 and scanned <= 10_000
    assert read("doc_id = 30001") == (0, 0)  # between known ids: the Bloom filter tells


def test_units_equal_the_library():
    encoder = orc_tokens.Encoder(public_tokenizers.path(orc_tokens.VOCABULARY))
    r = np.random.default_rng(1)
    alphabet = list(" \t\n\r\x0b\x1c\x85\xa0　​ab'é日1!#.-") + ["<|endoftext|>", "'s", "  "]
    texts = ["".join(r.choice(alphabet, 30)) for _ in range(600)]
    texts += ["it's 'quoted' don't!x \"'s.y\" a-b_c 12%x 3.5e é.x…y don't-'ll", "", "\x00\x1f a", "a  b", "   "]
    for part in (texts, texts[::-1]):
        assert [x.tolist() for x in encoder.encode(pa.array(part))] == [encoder.library.encode(t, add_special_tokens=False).ids for t in part]


def test_html_of_the_sample(spark):
    """All text of the article element, and nothing else, of every page of the sample."""
    model = html_extraction.fit(html_training.labelled_pages())
    pages = [r.html for r in spark.read.parquet(f"{cases.SF}/pages.parquet").collect()]
    for page, text in zip(pages, html_extraction.extract(pages, model), strict=True):
        elements, blocks = html_extraction.parse(page)

        def inside(i: int, elements=elements) -> bool:
            return i >= 0 and (elements[i].tag == "article" or inside(elements[i].parent))

        assert text == "\n".join(t for e, t in blocks if inside(e))


def test_html_marginals_are_exact():
    """Sum-product against the sum over all assignments of a small tree."""
    elements, _ = html_extraction.parse("<body><nav><ul><li>a<li>b</ul></nav><article><p>x y z</article>")
    f = html_extraction.forest_of([elements])
    r = np.random.default_rng(0)
    w, pair = r.normal(size=html_extraction.N_FEATURES), r.normal(size=(len(html_extraction.KINDS), 2, 2))
    n, total, on = len(elements), 0.0, np.zeros(len(elements))
    for bits in range(1 << n):
        y = np.array([(bits >> i) & 1 for i in range(n)])
        score = (f.x @ w) @ y + sum(pair[f.kind[i], y[f.parent[i]], y[i]] for i in range(n) if f.parent[i] >= 0)
        total += np.exp(score)
        on += np.exp(score) * y
    assert np.allclose(html_extraction.marginals(f, w, pair), on / total)


def test_html_held_out_pages():
    model, right = html_extraction.fit(html_training.labelled_pages()), 0
    pages = html_training.labelled_pages(200, seed=99)
    for page, text in zip(pages, html_extraction.extract(pages, model), strict=True):
        elements, blocks = html_extraction.parse(page)
        right += text == "\n".join(t for e, t in blocks if elements[e].label)
    assert right >= 0.95 * len(pages)


def test_html_odd_pages(spark):
    page = "<html><body><nav><a href=x>Menu</a></nav><article><h1>T&eacute;st</h1><p>one\n two&nbsp;&amp;<b>three<p>four &lt; five</p><script>var x='</p>'</script></article><div class=comments><p>Nice!</p></div></body>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<" * 5000), (4, "w", "<div>" * 3000 + "deep"), (5, "x", "</p></div><p"), (6, "y", "<!-- open <p>never")]
    got = html_extraction.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and sum(r.text == "Tést\none two &three\nfour < five" for r in got) == 2
    assert all(r.n_chars == len(r.text) for r in got) and {r.page_id: r.text for r in got}[2] == ""
    assert html_extraction.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_of_unclosed_elements(spark):
    """No text of the article goes with an element that isn't closed; forms, scripts and styles do."""
    model = html_extraction.fit(html_training.labelled_pages())
    long = "A sentence of the article that says quite a lot, and then something more. " * 3
    wrap = lambda x: f"<body><nav><ul><li><a href=/>Home</a></ul></nav><article><p>{long}</p>{x}</article><footer>&copy; x</footer>"
    main = " ".join(long.split())
    pages = {
        f"<select><option>a<option>b<p>{long}</p>": [main, main],
        "<p>The area is <math>x</math> metres, and the <svg><text>y</text></svg> is <object>z</object> of it.</p>": [main, "The area is x metres, and the y is z of it."],
        f"<title><p>{long}</p>": [main, main],
        f"<textarea><p>{long}</p>": [main, main],
        f"<noscript><p>{long}</p>": [main, main],
        f"<script>var a = 1</script><style>p {{}}</style><p>{long}<br>And a <i>word <b>more.</p>": [main, f"{main} And a word more."],
    }
    assert html_extraction.extract([wrap(x) for x in pages], model) == ["\n".join(x) for x in pages.values()]


def test_html_is_read_in_linear_time():
    for page in ("<b>" * 40_000 + "<div>" * 40_000, "<i>" * 30_000 + "<b>" * 30_000 + "</i>" * 30_000, "<blockquote>" * 30_000, "<div>" * 30_000 + "</p>" * 30_000, "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000, "<a>" * 30_000 + "</div>" * 30_000):
        began = time.process_time()
        html_extraction.parse(page + "end")
        assert time.process_time() - began < 3


@pytest.mark.parametrize("unit", ["<a b ", '<a b=" ', "<title>", "<!x ", "<iframe>", "</title ", "<head>", "<!-- x ", "<title></title ", '<b>"<', '<a "><b "<', "<a b='\" "])
def test_a_megabyte_of_broken_markup(unit):
    """No search starts again at each bracket, with a last bracket and without one."""
    for tail in ("", ">"):
        began = time.process_time()
        html_extraction.parse(unit * (1_000_000 // len(unit)) + tail)
        assert time.process_time() - began < 4


def test_comments_without_an_end():
    shown = lambda page: [t for _, t in html_extraction.parse(page)[1]]
    assert shown("<p>a<!-- b <p>c") == ["a"] and shown("<p>a<!-- b --><p>c<!-- d") == ["a", "c"]
    assert shown("<p>x < y and <b") == ["x < y and <b"] and shown("a<!--") == ["a"] and shown("a<!-->b") == ["a"]


def test_html_with_other_columns(spark):
    rows = spark.createDataFrame([(1, "u", "<article><p>One text of a page.</p></article>", "x", 5, 6)], "page_id long, url string, html string, text string, n_chars int, label int")
    got = html_extraction.main_texts(rows).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", len(got[0].text))]


def test_shared_folder_is_the_sessions(spark):
    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
