from conftest import SF_SMALL, rows
from tidewater.plans.conversations import conversation_check_df
from tidewater.plans.pages import canonical, page_text_df
from tidewater.plans.relational import event_pivot_df


def test_conversation_check_flags_made_up_faults(spark):
    made = spark.createDataFrame(
        [
            (1, 0, "system", "be nice"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
            (2, 0, "user", "hi"), (2, 1, "user", "again"), (2, 3, "assistant", " "),
            (3, 1, "robot", "x"), (3, 2, "system", "late"),
        ],
        "conv_id long, turn long, role string, text string",
    )
    for block in (2, 3, 1000):
        got = {r.conv_id: r for r in conversation_check_df(made, block_rows=block).collect()}
        assert got[1].valid
        assert (got[2].n_role_repeat, got[2].n_turn_gap, got[2].n_blank) == (1, 1, 1)
        assert (got[3].n_bad_role, got[3].n_late_system, got[3].n_turn_gap) == (1, 1, 1)


def test_conversation_check_fixture_is_clean(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    out = conversation_check_df(conv, block_rows=50)
    assert out.filter("NOT valid").count() == 0
    assert out.count() == conv.select("conv_id").distinct().count()


def test_canonical_urls_of_made_up_rows(spark):
    want = {
        "https://www.Example.com/Path/": "example.com/Path",
        "http://m.example.com/path#top": "example.com/path",
        "http://example.com/x?pref=1&b=2": "example.com/x?b=2&pref=1",
        "http://example.com/x?b=2&utm_source=feed&a=1&ref=x#f": "example.com/x?a=1&b=2",
        "http://example.com/x?ref=x&gclid=3": "example.com/x",
        "http://example.com/x?href=9": "example.com/x?href=9",
        "http://example.com/shop/utm_a=1/y": "example.com/shop/utm_a=1/y",
        "http://example.com/?": "example.com",
        "http://example.com?q=A&&": "example.com?q=A",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in want], "url string")
    assert {r.url: r.c for r in df.select("url", canonical("url").alias("c")).collect()} == want


def test_page_text_of_made_up_rows(spark):
    pages = {
        "<header><nav>..</nav>left</header><p>kept</p>": ("kept", 0),
        "<script>var a='</nav>';x()</script>kept": ("kept", 0),
        "<nav>a<nav>b</nav>c</nav>kept<script>never closed": ("kept", 0),
        "<HEADER class='a'>x</HEADER >kept</nav> too": ("kept too", 0),
        "<head><title>t</title></head><style>p{}</style>a&lt;b<!-- <nav> -->": ("a<b", 0),
        "<a href='x'>one</a> <a class=c href=y>two</a> <a data-href=\"z\">three</a>": ("one two three", 2),
        "<nav>left " * 6 + "a" + " left</nav>" * 6 + "kept": ("kept", 0),
        "<nav>" * 400 + "x" + "</nav>" * 400 + "kept" + "<nav>x</nav>" * 300: ("kept", 0),
        "<!-- <script> -->kept one<p>two</p><script>x</script> three": ("kept one two three", 0),
        "<script>a = '<!--'</script>kept<!-- x --> too": ("kept too", 0),
        "<!-- a --><style><!-- p{} --></style>kept": ("kept", 0),
        "<nav>open <aside>x<nav>y</nav></aside> kept": ("open kept", 0),
        "</nav></nav>kept<nav>x</nav>": ("kept", 0),
        "a\x01b\x02c": ("a b c", 0),
        "": ("", 0),
        None: (None, None),
    }
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "page_id long, html string")
    got = {r.page_id: (r.main_text, r.n_links) for r in page_text_df(df).collect()}
    assert [got[i] if h is not None else (got[i][0], None) for i, h in enumerate(pages)] == list(pages.values())


def test_event_pivot_counts_unlisted_types(spark):
    df = spark.createDataFrame([(1, "view"), (1, "hover"), (1, None), (2, "click")], "user_id long, event_type string")
    got = {r.user_id: (r.click, r.view, r.other) for r in event_pivot_df(df).collect()}
    assert got == {1: (0, 1, 2), 2: (1, 0, 0)}
