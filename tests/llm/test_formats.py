import base64
import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, html_text, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(vocabulary.lines), special_tokens={})


def odd_texts():
    rng = random.Random(4)
    made = ["", " ", "a", "'ll don't", " " * 700 + "x", "!" * 900, "ab" * 400, "日本語 текст", "x\x1c\x1c y\x85\x85z", "e" * 6000, "<|endoftext|>"]
    made += ["".join(rng.choice("abcdefgh") for _ in range(500)) for _ in range(5)]
    return made + ["".join(rng.choice(" \n\t's1²é_-!\x1c\x85\xa0abc") if rng.random() < 0.7 else chr(rng.randrange(0x300)) for _ in range(30)) for _ in range(300)]


def test_ids_are_those_of_the_library(vocabulary, library):
    coder, texts = bpe.Coder(vocabulary), odd_texts()
    ids, edges = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(ids, edges) == [t.encode() for t in texts]


def test_memory_of_words_may_be_forgotten(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    coder = bpe.Coder(vocabulary)
    for text in ("one two three four", "five six " * 9, " ".join(map(str, range(90))), "one two"):
        assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_round_trip_of_documents(spark, vocabulary, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(-1, None, 3), (-2, "", 4), (-2, "", 4), (None, "x y", 5)], "doc_id long, text string, n_tokens int")
    rows = docs.withColumn("n_tokens", F.lit(1)).select("doc_id", "text", "n_tokens").unionByName(odd)
    encoded = bpe.encode(rows, vocabulary)
    got = sorted(((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded.collect()))
    want = []
    for r in rows.collect():
        ids = library.encode_ordinary(r.text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert sorted(map(tuple, bpe.round_trip(rows, vocabulary).collect()), key=str) == sorted((tuple(r)[:4] for r in encoded.collect()), key=str)
    texts = sorted((str(r.doc_id), (r.text or "").encode()) for r in rows.collect())
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in bpe.decode(encoded, vocabulary).collect()) == texts
    assert bpe.encode(rows.limit(0), vocabulary).count() == 0


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "|", "\\", ">", "im_end", "<|im_end|>"]) for _ in range(rng.randrange(8)))
        held = chat.escape(text)
        assert chat.unescape(held) == text and not any(c in held for c in chat.CONTROL)


def test_chat_round_trip(spark):
    control = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", control), (1, 1, "assistant", control), (2, 1, "assistant", "b"), (2, 0, "assistant", "a"), (2, 2, None, None), (3, None, "system", ""), (None, 1, "assistant", "né" * 50_000), (4, 0, "assistant", "x"), (4, 0, "assistant", "x"), (5, 0, "a\nassistant", "<\\|")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    vocabulary = chat.Vocabulary(RANKS, public_tokenizers.PATTERN)
    turns = chat.format_turns(table, vocabulary)
    got = {r.conv_id: r for r in chat.read_back(turns, vocabulary).collect()}
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        by.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for conv, said in by.items():
        loss = "".join(t for r, t in said if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(said) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    tokens = vocabulary.tokens()
    for r in turns.collect():
        assert sum(i >= tokens.first for i in r.ids) == 3 and len(r.ids) == len(r.mask)
    assert chat.read_back(chat.format_turns(table.limit(0), vocabulary), vocabulary).count() == 0


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A &amp; B</h1><p>one\n two<p>three <b>four</b><br>five</article><footer>no</footer>", "A & B\n\none two\n\nthree four five"),
    ("<nav><ul><li>m</ul></nav><main><p>x</p><aside>no</aside><section class='comments'><p>no</p></section></main>", "x"),
    ("<div class='ad'>no</div><div class='content'><p>y &lt;z&gt; &eacute;</p><form><input><label>no</label></form></div>", "y <z> é"),
    ("<div id=cookie-notice>no</div><p>a<script>if(1<2){'</p>'}</script>b</p><style>no</style><!-- no <p>no</p> -->", "ab"),
    ("plain < text", "plain < text"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></article>", "1\n\n2\n\n3\n\n4"),
    ("<header class='site'>no</header><article><header><h1>t</h1></header><p>u</p></article>", "t\n\nu"),
])
def test_main_text_of_a_page(body, text):
    assert html_text.main_text(html_text.parse(page(body)), frozenset()) == text


def test_style_trees_remove_what_repeats_on_a_host(spark):
    rows = [(k, f"http://h{k % 2}.example.com/{k}", page(f"<div class='top'><span>Welcome to site</span><div>Log in here</div></div><div class='text'><div>Story {k} tells of {k * 7}</div></div><div class='end'>All rights of {'us' if k % 3 else 'them'}</div>")) for k in range(40)]
    found = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {k: f"Story {k} tells of {k * 7}" for k in range(40)}
    shuffled = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), broadcast_paths=0)
    assert {r.page_id: r.text for r in shuffled.collect()} == found


def test_copies_of_an_article_are_not_presentation(spark):
    rows = [(k, "http://h.example.com/", page(f"<article><h1>Same</h1><p>Same words.</p></article><i>{k}</i>")) for k in range(30)]
    assert {r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"Same\n\nSame words."}


def test_copies_of_a_page_count_once_over_all_partitions(spark):
    one = page("<article><h1>Same</h1><div><p>Same words.</p></div><ul><li>a<li>b</ul></article>")
    rows = [(k, "http://h.example.com/", one) for k in range(40)] + [(40 + k, "http://i.example.com/", one) for k in range(2)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 8):
        assert {r.text for r in html_text.extract(table.repartition(parts)).collect()} == {"Same\n\nSame words.\n\na\n\nb"}


def test_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (2, "no url", ""), (None, "http://x/", "<p>" * 3000 + "deep"), (3, "http://x/", "<article>" + "w " * 100_000), (4, "http://x/", "<<>< a='\"><p x=\"1>2\">q</p>"), (5, "http://x/", "<script>never ends")]
    table = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    found = sorted(((str(r.page_id), r.text) for r in html_text.extract(table).collect()))
    assert len(found) == len(rows) and ("1", "") in found and ("2", "") in found and ("None", "deep") in found and ("5", "") in found
    assert dict(found)["3"] == ("w " * 100_000).strip()
    assert html_text.extract(table.limit(0)).count() == 0


def test_extraction_equals_a_plain_cut_of_the_article(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h\d)>", inner))
        assert found[r.page_id] == "\n\n".join(x for x in parts if x)


def brute_records(rows, least=0):
    firsts = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if i is not None and len(body) >= least:
            firsts[body] = max(firsts.get(body, i), i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        first = firsts.get(body)
        later = i is not None and first is not None and i < first
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if later else "response", first if later else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, tmp_path, chunk, least):
    rows = [(1, "u", None), (2, None, ""), (3, "a\r\nb: c", "x" * 300), (4, "v", "x" * 300), (4, "v", "x" * 300), (None, "w", "x" * 300), (5, "é", "é\r\n\r\nWARC/1.1\r\n"), (6, "z", "abc"), (7, "z", "abc"), (8, "z", "<p>" * 500)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int").repartition(3)
    found = warc.round_trip(table, str(tmp_path / "a"), least, chunk).drop("url").collect()
    assert sorted(map(tuple, found), key=str) == brute_records(rows, least)
    assert warc.round_trip(table.limit(0), str(tmp_path / "b")).count() == 0


def test_warc_bytes_are_a_record(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write(spark.createDataFrame([(8, "http://x/", "<p>" * 500)], "page_id long, url string, html string"), path, chunk_bytes=100)
    record = spark.read.parquet(path).first().record_id
    head, _, rest = warc.record_bytes(spark, path, record).partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest == b"<p>" * 500 + b"\r\n\r\n"
    assert b"Content-Length: 1500" in head and spark.read.parquet(path).count() == 15


def test_damaged_archives_are_errors(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write(spark.createDataFrame([(1, "u", "abcdef" * 50)], "page_id long, url string, html string"), path, chunk_bytes=100)
    cut = spark.read.parquet(path).where("chunk_no <> 1")
    cut.write.parquet(str(tmp_path / "b"))
    with pytest.raises(Exception, match="out of order"):
        warc.read(spark, str(tmp_path / "b")).collect()
