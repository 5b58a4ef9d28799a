"""Parts and rules against plain code; the model on held-out URLs."""

import re

import numpy as np

from winnow.llm import urls


def parts(u):
    i = (u or "").find("://")
    if i < 0:
        return "", ""
    rest = u[i + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    low = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return low, re.match(r"[^?#]*", rest[len(host) :])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_rules_and_nulls(spark):
    us = [None, "", "no scheme", "http://Example.NET/en/x?y#z", "https://a.b.example.net/", "http://net", "http://x.org/fr/a", "http://example.com/de/1", "ftp://notnet/", "http://a://b/c", "x://h?q/p", "http://É.net/en/", "http://h\n.net/p\nq", "HTTP://WWW.ORG/fr/", "http://example.net:80/en/"]
    df = spark.createDataFrame(list(enumerate(us)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    for i, u in enumerate(us):
        h, p = parts(u)
        assert (got[i].host, got[i].path) == (h, p)
        assert got[i].rule == rule(h, p)[0]
        assert got[i].verdict == (rule(h, p)[1] or got[i].verdict) and got[i].verdict in ("allow", "block")
    assert got[0].verdict == "allow"


def test_held_out_accuracy():
    rows = urls.labelled(1200, 99)
    s = urls.weights().score([r[0] for r in rows], [r[1] for r in rows])
    assert ((s > 0) == np.array([r[2] for r in rows])).mean() > 0.93


#: Written apart from the table that trains; real forms of both kinds.
SEEN_ELSEWHERE = {
    1: "best-buys.ru/cheap-watches bet365.com/ pokerstars.com/ pharmacy-discount-now.biz/ mega-casino-slots.com/bonus cheapviagra24.net/ hot-girls-webcam.com/live instant-payday-loans.org/apply free-bitcoin-now.top/win windows-crack-keygen.net/download replica-rolex-shop.cn/ sex-dating-club.info/join online-casino-bet.net/play lottery-prize-claim.xyz/ buy-cheap-meds.com/order pornhub-free-videos.net/ escort-service-vip.com/ win-free-iphone.club/claim cash-loans-now.biz/ torrent-warez.to/keygen",
    0: "spamhaus.org/ library.cornell.edu/hours www.britannica.com/science/photosynthesis en.wikipedia.org/wiki/River docs.python.org/3/library/re.html nature.com/articles/s41586 www.nhs.uk/conditions/asthma gardenersworld.com/plants weather.gov/forecast openstreetmap.org/relation/7 museum.wales/cardiff history.state.gov/countries chess.com/article/openings bbc.co.uk/news/science arxiv.org/abs/1706 github.com/numpy/numpy/issues stackoverflow.com/questions/11 school.kids-park.org/lunch theguardian.com/books recipes.home-kitchen.com/soup",
}


def test_accuracy_on_other_urls():
    rows = [(u.partition("/")[0], "/" + u.partition("/")[2], k) for k, us in SEEN_ELSEWHERE.items() for u in us.split()]
    trained = {r[:2] for r in urls.by_hand()}
    assert not trained & {r[:2] for r in rows}
    s = urls.weights().score([r[0] for r in rows], [r[1] for r in rows])
    wrong = [r[0] for r, x in zip(rows, s, strict=True) if (x > 0) != bool(r[2])]
    assert len(wrong) <= 3 and not {"best-buys.ru", "bet365.com", "pokerstars.com", "pharmacy-discount-now.biz", "spamhaus.org"} & set(wrong), wrong


def test_accuracy_by_folds():
    """Each fifth of the hand-made table by a model of the others."""
    rows = urls.by_hand()
    assert len(rows) <= 250 and len(set(rows)) == len(rows)
    good = 0
    for k in range(5):
        part = [r for i, r in enumerate(rows) if i % 5 == k]
        model = urls.Weights([r for i, r in enumerate(rows) if i % 5 != k] * 3 + urls.labelled(300))
        good += sum((x > 0) == bool(r[2]) for r, x in zip(part, model.score([r[0] for r in part], [r[1] for r in part]), strict=True))
    assert good / len(rows) > 0.8


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, host string")).collect() == []
