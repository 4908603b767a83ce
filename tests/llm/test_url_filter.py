from __future__ import annotations

from hypothesis import given, settings, strategies as st

from plinth.llm.queries import URL_RULES
from plinth.llm.url_filter import Rule, UrlTrie, judge_urls, split_url

RULES = [Rule.parse(v, r) for v, r in URL_RULES]


def plain(host, path, rules):
    fits = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"), default=None)


@given(st.lists(st.sampled_from(["com", "net", "org", "example", "a"]), min_size=1, max_size=3), st.sampled_from(["", "/", "/en/", "/en/7", "/en/71/x", "/de/8", "/de", "/es/", "/en"]))
@settings(max_examples=200, deadline=None)
def test_trie_is_the_longest_rule(labels, path):
    host = ".".join(labels)
    a, b = UrlTrie(RULES).match(host, path), plain(host, path, RULES)
    assert (a and a.name) == (b and b.name)


def test_parts_of_urls():
    assert split_url("HTTP://WWW.Exämple.com/A?b#c") == ("www.exämple.com", "/A")
    assert split_url("x://h?y") == ("h", "") and split_url("nothing") == ("", "") and split_url(None) == ("", "") and split_url("a://") == ("", "")
    assert split_url("a://b://c/d") == ("b:", "//c/d")


def test_rows_and_join_form_agree(spark):
    urls = [None, "", "no scheme", "http://a.example.com/en/71", "http://com/en/", "http://B.COM/en/x", "https://q.net/de/8", "https://example.net/de/81?z", "http://x.org/es/", "http://x.org/es", "://com/en/1", "http://.com/en/1"] * 2
    df = spark.createDataFrame([(i if i else None, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    get = lambda most: sorted(map(tuple, judge_urls(df, RULES, "page_id", "url", max_bytes=most).collect()), key=repr)
    assert get(1 << 20) == get(0) and len(get(0)) == len(urls)
    assert judge_urls(df.limit(0), RULES, "page_id", "url").count() == 0
