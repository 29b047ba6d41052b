"""Brute force for entity resolution: records one after another, as plain Python."""

from __future__ import annotations


def digits(p):
    return "".join(c for c in p if c.isdigit())


def arrive(records):
    """Company (founding ingest_seq) of every record when they arrive in order."""
    companies, where = [], {}
    for r in sorted(records, key=lambda r: r["ingest_seq"]):
        fps = {digits(p) for p in r["phones"]}

        def found(test):
            return next((c for c in companies if test(c)), None)

        c = r["inn"] and found(lambda c: c["inn"] == r["inn"])
        c = c or (r["website"] and found(lambda c: c["website"] == r["website"]))
        c = c or found(lambda c: r["source_url"] in c["urls"])
        c = c or (r["name"] and found(
            lambda c: c["name"] == r["name"].lower() and c["fps"] & fps and not (r["inn"] and c["inn"])
        ))
        if not c:
            c = {"id": r["ingest_seq"], "inn": None, "website": None, "name": None, "urls": set(), "fps": set(),
                 "address": None, "date": "", "named": "", "first": r["scrape_date"]}
            companies.append(c)
        fresh = r["scrape_date"] >= c["date"]
        c["inn"] = c["inn"] or r["inn"]
        c["website"] = c["website"] or r["website"]
        if r["name"] and r["scrape_date"] >= c["named"]:
            c["name"], c["named"] = r["name"].lower(), r["scrape_date"]
        if r["address"] and fresh:
            c["address"] = r["address"]
        c["date"] = r["scrape_date"]
        c["urls"].add(r["source_url"])
        c["fps"] |= fps
        where[r["ingest_seq"]] = c["id"]
    return where, {c["id"]: c for c in companies}


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in list(parent)}
