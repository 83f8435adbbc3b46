import datetime as dt
import json
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import columns as C
from pagemill.operators import articles as A
from pagemill.operators import pages as P
from pagemill.operators import sites as S
from pagemill.operators import tasks as T
from pagemill.plans import queries as Q
from pagemill.sources import html as H
from pagemill.streaming import schedule

SF = "/root/testdata/sf0.001"


def page(content):
    return f'<h1>Test title</h1><div id="content">{content}</div>'


def box(content):
    found = H.parse(page(content))
    return found.lines(found.first("#content"))


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "c string").select(f(F.col("c"))).first()[0]


def test_ordered_text_keeps_order_and_repeats():
    assert box("开头。<div>直接正文<p>重复。</p><p>重复。</p><div>尾声。</div></div>结束。").split("\n") == ["开头。", "直接正文", "重复。", "重复。", "尾声。", "结束。"]
    assert box("<p>Hello <b>world</b>! Again.</p>" * 2) == "Hello world! Again.\nHello world! Again."


def test_deep_nesting_and_huge_nodes():
    body = "正文ABC" * 20000
    assert H.article_of(page("<div>" * 30 + f"<p>{body}</p>" + "</div>" * 30), "")["content"] == body
    text = "x" * (11 << 20) + "END"
    assert box(f"<p>{text}</p>") == text


def test_index_number_follows_its_label():
    found = H.article_of(page("<p>索 引 号</p><p>00001854-5/2026-00076</p>" + "政务正文。" * 20), "")
    assert found["indexNumber"] == "00001854-5/2026-00076" and found["reject"] is None


@pytest.mark.parametrize("encoding", ["utf-8", "gb18030", "utf-16"])
def test_decoding_keeps_every_character(encoding):
    text = "一段完整正文。" * 50 + "终点"
    assert H.decode_page(text.encode(encoding))[0] == text


def test_decoding_candidates():
    assert H.decode_page('<meta charset="gbk">中文'.encode("gbk")) == ('<meta charset="gbk">中文', "gbk")
    assert H.decode_page("é".encode(), "iso-8859-1")[1] == "utf-8"
    for name in ("undefined", "hex", "no-such"):
        assert H.decode_page(f'<meta charset="{name}">a'.encode())[1] == "utf-8"
    assert H.decode_page('<META CHARSET="latin-1">é'.encode())[1] == "utf-8"  # the rule looks for lower-case words
    with pytest.raises(ValueError):
        H.decode_page(b"\xff\xff\x81")


def test_removal_in_a_rejected_box_counts_later():
    found = H.article_of('<h1>Test title</h1><div class="content">kurz<div class="share"><img src="/a.png">' + "<p>" + "geteilt " * 20 + '</p></div></div><p>' + "ein Absatz " * 10 + '</p><img src="/b.png">', "https://a.test/x")
    assert "geteilt" not in found["content"] and found["images"] == ["https://a.test/b.png"]


def test_length_gates():
    assert H.article_of("<h1>Test title</h1><p>" + "a" * 29 + "</p>", "")["reject"] == "short body"
    assert H.article_of("<h1>Test title</h1><p>" + "a" * 30 + "</p>", "")["reject"] is None
    assert H.article_of("<h1>abc</h1><p>" + "a" * 50 + "</p>", "")["reject"] == "no title"


def test_title_time_source_images():
    root = H.parse('<title>Ein Titel_Seite - Amt</title><meta property="article:published_time" content="2024/1/5 10:00"><span class="source">来源：新华社</span>')
    assert (H.title_of(root), H.publish_time_of(root), H.source_of(root)) == ("Ein Titel", "2024-1-5 10:00", "新华社")
    imgs = "".join(f'<img src="/{i}.jpg?x">' for i in range(7)) + '<img data-src="/z.gif">'
    assert H.images_of(H.parse(imgs), "https://a.test/") == [f"https://a.test/{i}.jpg?x" for i in range(5)]
    assert H.images_of(H.parse('<img src="http://[x"><img src="/a.png">'), "https://a.test/") == ["https://a.test/a.png"]


def test_numbers_skip_scripts():
    assert H.numbers_of(H.parse("<script>〔2020〕1号 索引号：abcde</script><p>国发〔2024〕15号</p>")) == ("〔2024〕15号", None)


def test_links(spark):
    html = '<a href="/20260917/article.html">完整文章标题链接</a><a href="https://evil.test/20260917/a.html">x</a><a href="/a.pdf">pdf</a><a href="javascript:x">j</a><a href="#t">t</a><a href="/20260917/article.html?q=1#f">noch</a>'
    rows = P.links(spark.createDataFrame([(1, "https://test.invalid/index", html)], "page_id long, url string, html string")).collect()
    assert [(r.link, r.place) for r in rows] == [("https://test.invalid/20260917/article.html", 0)]


def test_canonical(spark):
    rows = [("u", "t", "c", " ", "s", None), ("u", " ", "c", None, None, ["i"]), (None, "t", "c", None, None, None)]
    valid, rejected = P.canonical(spark.createDataFrame(rows, "url string, title string, content string, siteName string, media_name string, images array<string>"))
    row = valid.first()
    assert tuple(valid.columns) == P.FIELDS and row.siteName == "s" and row.images == []
    assert sorted(r.reject_reason for r in rejected.collect()) == ["blank title", "missing field"]


def test_write_articles_keeps_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("u", "t", "c", "Amt/1", "k/1", "ch")], "url string, title string, content string, siteName string, category string, channel string")
    P.write_articles(P.canonical(rows)[0], str(tmp_path / "out"))
    files = list((tmp_path / "out").rglob("part-*"))
    assert "p_category=k_1/p_site=Amt_1/p_channel=ch" in str(files[0]) and '"docNumber":null' in files[0].read_text() and '"images":[]' in files[0].read_text()


def test_column_rules(spark):
    assert one(spark, "　\x1c ", C.blank_to_null) is None and one(spark, " a ", C.blank_to_null) == " a "
    assert one(spark, "国发〔2024〕15号", C.doc_number) == "〔2024〕15号"
    assert one(spark, "2024年1月5日 10:00", C.publish_time) == "2024-1-5"
    assert one(spark, "索引号：000-5/1", C.index_number) == "000-5/1"
    assert one(spark, "https://www.a.test:80/x", C.host_base) == "a.test:80"
    assert one(spark, "https://www.a.test/", lambda u: F.regexp_like(F.lit("http://a.test/x/20240101.html"), C.site_pattern(u)))
    assert one(spark, "x.PDF", C.is_asset) and one(spark, "http://中.cn/", C.is_invalid_url)


def test_resolution_steps(spark):
    rules = spark.createDataFrame([("GOV", 0, "甲", "g"), ("MINISTRY", 0, "部报", "m0"), ("MINISTRY", 1, "报", "m1"), ("PROVINCE", 0, "山东", "p")], "tier string, ord int, key string, url string")
    names = [("甲\n", None), ("大部报社", "https://ok.test"), ("乙", "https://ok.test"), ("山东某", ""), ("某某县", None), ("丙", "nodot")]
    found = {r.name: (r.home_url, r.source_type, r.is_fallback) for r in S.resolve(spark.createDataFrame(names, "name string, url string"), rules).collect()}
    assert found["甲\n"] == ("g", "GOV_DIRECT", False) and found["大部报社"] == ("m0", "MINISTRY_FUZZY", False)
    assert found["乙"][1] == "ORIGINAL_VALID" and found["山东某"] == ("p", "PROVINCIAL_HUB_山东", True)
    assert found["某某县"][1] == "NATIONAL_HUB_FALLBACK" and found["丙"][1] == "DEFAULT_FALLBACK"


def test_task_fold_equals_steps(spark):
    random.seed(5)
    rows = [(k, i // 2, i, random.choice(["begin", "fail", "over_limit", "done", "retry"])) for k in range(200) for i in range(random.randint(1, 12))]
    found = {r.key: (r.status, r.failures) for r in P.fold_tasks(spark.createDataFrame(rows, "key long, ts long, seq long, event string")).collect()}
    for key in range(200):
        state = ("pending", 0)
        for event in (r[3] for r in rows if r[0] == key):
            state = schedule.step(*state, event)
        assert found[key] == state


def test_recover_and_retry(spark):
    tasks = spark.createDataFrame([(1, "running", 1), (2, "running", 0), (3, "deferred", 2), (4, "done", 0)], "key long, status string, failures long")
    assert {r.key: (r.status, r.failures) for r in T.recovered(tasks, "now").collect()} == {1: ("deferred", 2), 2: ("pending", 1), 3: ("deferred", 2), 4: ("done", 0)}
    assert {r.key: r.status for r in T.retried(tasks, which=F.col("key") > 2)[0].collect()} == {1: "running", 2: "running", 3: "pending", 4: "done"}


def test_stream_equals_batch(spark, tmp_path):
    random.seed(6)
    rows = [(k, i, i, random.choice(["begin", "fail", "done", "retry"])) for k in range(20) for i in range(6)]
    data = spark.createDataFrame(rows, "key long, ts long, seq long, event string")
    data.coalesce(1).write.parquet(str(tmp_path / "in"))
    query = schedule.stream_tasks(spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("update").format("memory").queryName("tasks").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("tasks").collect())) == sorted(map(tuple, P.fold_tasks(data).collect()))


def test_rounds_and_slots(spark):
    r = schedule.Rounds(2).start()
    assert r.start() is r
    r = r.end(schedule.BUSY).start().end(0).start().end(-9).start().end(0)
    assert r.over and r.attempts == 4 and r.start() is r
    slots = spark.sql("select timestamp_ntz'2026-09-14 09:00:00' t union all select timestamp_ntz'2026-09-14 10:00:00'").select("t", schedule.next_slot(F.col("t"), 18, 0, 8).alias("s"))
    assert [str(x.s) for x in slots.orderBy("t").collect()] == ["2026-09-14 10:00:00", "2026-09-15 10:00:00"]


@pytest.mark.parametrize("name", [n for n in Q.SQL if n not in Q.task_queries.SQL])
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for table in ("pages", "documents", "orders", "nation", "events", "part", "supplier", "lineitem"):
        db.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = db.sql(Q.SQL[name]).df()
    got = Q.QUERIES[name](spark, SF).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).values.tolist()))
    assert plain(got) == plain(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab c\n", min_size=1, max_size=6), max_size=6))
def test_ordered_text_keeps_all_words(parts):
    text = H.parse("".join(f"<p>{p}</p>" for p in parts)).lines(0)
    assert text.split() == " ".join(parts).split()


def test_comments_and_nesting():
    root = H.parse("<h1>a <!-- x --> b</h1><p>索引号<!-- x -->AB/12</p>")
    assert root.joined(root.first("h1")) == "ab" and H.numbers_of(root)[1] == "AB/12"
    assert root.lines(root.first("h1")) == "a b".replace(" ", "  ")
    assert H.parse("x<![foo[y]]>z</b>!<?pi?><!DOCTYPE q>").joined(0) == "xz!"
    deep = "<div>" * 20_000 + "<p>x" + "y</div>" * 20_000
    assert H.body_of(H.parse(deep), ()) == "x" + "y"
    with pytest.raises(H.OverLimit):
        H.within_budget("<b>" * 50, items=40)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-[]&;#abp =\"'x", max_size=60))
def test_any_markup_gives_a_page(text):
    assert set(H.article_of(text, "http://[bad")) == {"title", "publishTime", "source", "docNumber", "indexNumber", "content", "images", "reject"}
    H.anchors_of(H.parse(text), "http://[bad")


def test_selectors():
    root = H.parse('<div class="a b"><p class="sou" id="i">x<em>1</em></p></div><em>2</em><p class="xtimey">t</p>')
    texts = lambda s: [root.joined(k) for k in root.select(s)]
    assert texts("p.sou em") == ["1"] and texts("div.a.b") == ["x1"] and texts("#i, [class*='time']") == ["x1", "t"]
    assert texts("div p em") == ["1"] and texts("em") == ["1", "2"] and texts("div em em") == []
    root.drop(root.select("em", root.first("div")))
    assert texts("em") == ["2"] and texts("p.sou") == ["x"]
    with pytest.raises(ValueError, match="selector"):
        root.select("a > b")


def test_no_page_ends_the_job(spark):
    good = page("正文。" * 20)
    rows = [("u1", good), ("u2", "<![foo[x]]>" + good), ("u3", good + '<img src="http://[x">'), ("u4", "y" * 5000), (None, None), ("http://[x", good)]
    df = spark.createDataFrame(rows, "url string, html string")
    found = P.with_article(df, characters=4000).collect()
    assert [(r.url, r.out.reject) for r in found] == [("u1", None), ("u2", None), ("u3", None), ("u4", "over limit"), (None, "no title"), ("http://[x", None)] or len(found) == 6
    broken = P._rows(df, "struct<reject:string>", lambda p: 1 // 0, lambda reason: {"reject": reason}).collect()
    assert {r.out.reject for r in broken} == {"broken page: ZeroDivisionError"}
    raw = spark.createDataFrame([(1, bytearray(b"\xff\xff\x81"), None, None), (2, bytearray("中".encode("gb18030")), None, None), (3, None, None, None)], "id long, data binary, preferred string, declared string")
    assert {r.id: (r.text, r.encoding) for r in P.decoded(raw).collect()} == {1: (None, None), 2: ("中", "gb18030"), 3: ("", "utf-8")}


def test_articles_take_the_settings_of_their_sites(spark):
    html = '<div class="t">Eigener Titel</div><div class="b">' + "Text " * 20 + "</div><h1>Andere Zeile</h1>"
    pages = spark.createDataFrame([("u1", html, "s", "c"), ("u2", html, "fremd", None), ("u3", "<h1>x</h1>", "s", None)], "url string, html string, site string, channel string")
    sites = spark.createDataFrame([("s", "k", "n", [".t"], [".b"])], "name string, category string, sub_category string, title_selectors array<string>, content_selectors array<string>")
    found, rejected = A.articles_of(pages, sites, F.to_timestamp_ntz(F.lit("2026-09-17 08:05:09")))
    rows = {r.url: r for r in found.collect()}
    assert tuple(found.columns) == P.FIELDS
    assert (rows["u1"].title, rows["u1"].content, rows["u1"].source, rows["u1"].channel, rows["u1"].subCategory) == ("Eigener Titel", ("Text " * 20).strip(), "s", "c", "n")
    assert (rows["u2"].title, rows["u2"].siteName, rows["u2"].source, rows["u2"].publishTime, rows["u2"].crawledAt) == ("Andere Zeile", None, None, "2026-09-17", "2026-09-17 08:05:09")
    assert [(r.url, r.reject_reason) for r in rejected.collect()] == [("u3", "no title")]


def test_rule_and_channel_files(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps([{"tier": "GOV", "ord": 0, "key": "甲\n", "url": "g"}], ensure_ascii=False))
    assert [tuple(r) for r in S.read_rules(spark, str(path)).collect()] == [("GOV", 0, "甲\n", "g")]
    path.write_text('[{"tier": "ELSE", "ord": 0, "key": "k", "url": "g"}]')
    with pytest.raises(ValueError, match="1 rows"):
        S.read_rules(spark, str(path))
    path.write_text('[{"name": "甲", "channel": "首页", "url": "c", "ord": 0}, {"name": "甲", "channel": "要闻", "url": "d", "ord": 1}]')
    sites = spark.createDataFrame([("甲", "h"), ("乙", "i")], "name string, home_url string")
    found = S.site_channels(sites, S.read_channels(spark, str(path))).collect()
    assert sorted((r.name, r.channel, r.url) for r in found) == [("乙", "综合", "i"), ("甲", "要闻", "d"), ("甲", "首页", "c")]
    assert S.read_channels(spark, str(tmp_path / "none.json")).count() == 0


def test_round_loop():
    clock, codes, began = [dt.datetime(2026, 9, 14, 9, 0, tzinfo=dt.UTC).timestamp()], iter([0, 75, 1, OSError("x"), 0, 0, 0]), []

    def launch(now):
        began.append(now)
        if isinstance(code := next(codes), OSError):
            raise code
        return code

    def pause(seconds):
        clock[0] += seconds

    loop = schedule.RoundLoop(launch, 2, 18, 0, 8, 60, clock=lambda: clock[0], pause=pause)
    last = loop.run(days=1)
    assert (last.completed, last.attempts, last.over) == (2, 5, True) and str(began[0]) == "2026-09-14 18:00:00+08:00"
    assert loop.run(days=1).completed == 2 and began[5].day == 15
    loop.stop()
    assert loop.run() is None and schedule.RoundLoop(lambda now: 0, 1, 18, 0, at_once=True, clock=lambda: 0.0, pause=pause).run(days=1).over
    assert str(schedule.slot_after(dt.datetime(2026, 9, 14, 18, 0), 18, 0)) == "2026-09-15 18:00:00"


def test_common_tokens_are_read_as_html_parser_reads_them(monkeypatch):
    """HTMLParser took most of a page's time; it reads from the first token on that could be read in several ways."""

    class Plain(H.Page):
        def _read(self, text):
            self.feed(text)
            self.close()

    usual = '<!doctype html><html><body class="a b"><!-- x --><TITLE>T</TITLE><p ID="i" id="j">a &amp; b<br><b>c</b></p><script>x</script></body></html>'
    odd = ["a < b", "x &amp", "<p a=1>b</p>c", "<title>a & b</title><p>c", "<script>a<b</script>d", "<style>a</p></style>b", "<p/>a<br/>b", "<!-->c", "<![x[y]]>z<p>", "<plaintext>a</plaintext>b", "</ p>q", "<p\nclass='x'>r", '<a href="?a&amp;b">s</a>', '<p t="a>b">u</p>', "", "v"]
    state = lambda page: (page.tags, [v if isinstance(v, dict) else "".join(v) for v in page.values], page.ups, page.ends, page.by_tag, page.by_class, page.by_id)
    for text in [usual, *odd, *(usual + o + usual for o in odd)]:
        assert state(H.Page(text)) == state(Plain(text)), text
    monkeypatch.setattr(H.Page, "feed", None)
    assert H.article_of(usual, "https://h.test/")["content"] == "a & b\nc"
