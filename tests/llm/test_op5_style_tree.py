import html
import math
import re

import duckdb
import pytest
from conftest_llm import SMALL

from racelake.llm import op5_style_tree as op


def page(k, host="a.example", body=None, note="Same old note on every page."):
    body = body or f"<h1>Title {k}</h1><p>First &amp; {k} para\n  graph.<p>Second<br>line {k * 7}</p>"
    return (k, f"http://{host}/x/{k}", f"<html><head><title>t</title></head><body><div class='top'>{note}</div>"
            f"<div>{body}</div><div id=menu><a>m{k}</a></div><script>if (a < b) 'x</p>'</script></body></html>")


def run(spark, rows):
    df = spark.createDataFrame([(*r, "k", "h") for r in rows], "page_id long, url string, html string, key string, host string")
    return sorted(((r.page_id, r.text, r.n_chars) for r in op.extract(spark, df).collect()), key=repr)


def test_query_extracts_the_articles(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in op.op5_style_tree(spark, SMALL).collect()}
    for i, h in pages:
        inner = re.search(r"<article>(.*?)</article>", h, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", b))).split())
                  for b in re.split(r"<p>|</p>|</?h1>", inner)]
        assert got[i].text == "\n\n".join(b for b in blocks if b) and got[i].n_chars == len(got[i].text)


def test_low_entropy_branches_of_a_host_are_removed(spark):
    got = run(spark, [page(k) for k in range(12)])
    assert got == sorted(((k, t, len(t)) for k in range(12)
                          for t in [f"Title {k}\n\nFirst & {k} para graph.\n\nSecond line {k * 7}"]), key=repr)


def test_copies_of_one_page_and_small_hosts_give_no_evidence(spark):
    same = [(k, "http://b.example/", page(1)[2]) for k in range(10)]
    note = "Same old note on every page.\n\nTitle 1\n\nFirst & 1 para graph.\n\nSecond line 7"
    assert {t for _, t, _ in run(spark, same)} == {note}
    assert all(t.startswith("Same old note") for _, t, _ in run(spark, [page(k, f"h{k}.example") for k in range(4)]))


def body_of(k):
    return "".join(f"<p>Sentence {k * 31 + j} of a <b>longer</b> text, number {j}.</p>" for j in range(3 + k % 4))


def text_of(k):
    return "\n\n".join(f"Sentence {k * 31 + j} of a longer text, number {j}." for j in range(3 + k % 4))


def test_copies_on_a_host_do_not_empty_its_other_pages(spark):
    copy = page(999, body=body_of(999))[2]
    rows = [(k, f"http://big.example/{k}", copy) for k in range(400)]
    rows += [page(1000 + k, "big.example", body_of(k)) for k in range(100)]
    got = {i: t for i, t, _ in run(spark, rows)}
    assert got == {**{k: text_of(999) for k in range(400)}, **{1000 + k: text_of(k) for k in range(100)}}


def test_same_text_with_and_without_marked_article(spark):
    mark = lambda k, tag: f"<{tag}>{body_of(k)}</{tag}><div><p>Site notice</p><p>for all readers</p></div>"
    rows = [page(k, f"{tag}.example", mark(k, tag)) for tag in ("article", "section") for k in range(40)]
    got = run(spark, rows)
    assert sorted(t for _, t, _ in got) == sorted(text_of(k) for k in range(40) for _ in range(2))


def test_the_tree_is_asked_in_marked_articles(spark):
    """A repeated block inside the article goes; one text of its own at such a place stays, so does an article all alike."""
    line = lambda k: "Read more on our site" if k else "Correction of May"
    rows = [page(k, "news.example", f"<article>{body_of(k)}<div class=more><p class=x>{line(k)}</p></div></article>")
            for k in range(40)]
    want = {k: text_of(k) if k else f"{text_of(k)}\n\nCorrection of May" for k in range(40)}
    assert {i: t for i, t, _ in run(spark, rows)} == want
    alike = [page(k, "login.example", f"<article><p class=x>Log in</p></article><section><p>Teaser {k}</p></section>")
             for k in range(40)]
    assert {t for _, t, _ in run(spark, alike)} == {"Log in"}


def test_an_ancestor_of_an_important_place_stays(spark):
    """The outer blocks have one presentation, and differ on one page in ten only."""
    rows = [page(k, "deep.example", f"<div class=o><div class=i><h2>Head</h2>{f'<section>Rare {k}</section>' if k % 10 == 0 else ''}"
                                    f"</div></div><p>Body {k}</p>") for k in range(60)]
    assert {t for i, t, _ in run(spark, rows) if i % 10 == 0} == {f"Rare {k}\n\nBody {k}" for k in range(0, 60, 10)}
    assert {t for i, t, _ in run(spark, rows) if i % 10} == {f"Body {k}" for k in range(60) if k % 10}


def test_importance_against_counts(spark):
    """Low places equal those of entropies counted page by page."""
    bodies = [f"<h1>Title {k % 3}</h1><ul>{'<li>x</li>' * (k % 2)}</ul><p>{k}</p><h2>end {k // 30}</h2>" for k in range(40)]
    rows = [page(k, "e.example", b) for k, b in enumerate(bodies)] + [page(7, "e.example", bodies[7])]
    seen = {}
    for h in {r[2] for r in rows}:
        for place, hashes in op.parse(h, measure=True).places.items():
            seen.setdefault(place, []).append([x.intdigest() for x in hashes])
    entropy = lambda v: -sum(v.count(x) / len(v) * math.log(v.count(x) / len(v)) for x in set(v))
    want = {p for p, v in seen.items() if len(v) >= op.MIN_PAGES
            and max(entropy([x[j] for x in v]) for j in (0, 1)) / math.log(len(v)) < op.LOW_IMPORTANCE}
    df = spark.createDataFrame([(hash(r[2]) >> 1, "e", r[2]) for r in rows], "page long, host string, html string")
    got = {r.place for r in op.low_places(op._places(df)).collect()}
    assert got == want and len(seen) - len(want) > 1 < len(want)


def test_odd_pages(spark):
    long = "<p>" + "word " * 100_000 + "</p>"
    rows = [(1, None, None), (2, "", ""), (None, "x", "<p>a"), (3, "http://c/", long), (3, "http://c/", long),
            (4, "http://c/", "<div>" * 3000 + "deep")]
    got = run(spark, rows)
    assert got == sorted([(1, "", 0), (2, "", 0), (None, "a", 1), (3, ("word " * 100_000).strip(), 499_999),
                          (3, ("word " * 100_000).strip(), 499_999), (4, "deep", 4)], key=repr)
    assert run(spark, rows[:0]) == []


@pytest.mark.parametrize("markup,text", [
    ("a < b &lt;i&gt; &eacute;&#x41;", "a < b <i> éA"),
    ("<nav>n</nav><main><p>y</p><aside>z</aside></main><footer>f</footer>", "y"),
    ("<article>t<div class='comment-list'>c</div><form>f</form><p>u</article>after", "t\n\nu"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<p>one<b>two</b> three</p><!-- no --><style>p{}</style>", "onetwo three"),
    ("<div class=cookie-notice>c</div><div class=address>kept</div><p hidden>h</p>", "kept")])
def test_markup(markup, text):
    assert op.parse(markup).text() == text


def test_places_are_not_shuffled_by_their_own_key(spark):
    rows = spark.createDataFrame([page(k) for k in range(12)], "page_id long, url string, html string")
    plan = op.extract(spark, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and not re.search(r"Join .*place#\d+ = place#\d+.*page#\d+ = page#\d+|Join .*page#\d+ = page#\d+.*place#\d+ = place#\d+", plan)


def test_places_carry_a_number_for_their_host(spark, monkeypatch):
    seen, places = [], op._places
    monkeypatch.setattr(op, "_places", lambda pages: seen.append(dict(pages.dtypes)["host"]) or places(pages))
    assert len(run(spark, [page(k) for k in range(12)])) == 12
    assert seen == ["bigint"]
