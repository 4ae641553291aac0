"""A remote search for the tests: as many results as the query says; page 2 of "broken" never comes."""

import random


def fetch(query, page):
    kind, n = query.split()
    if kind == "broken" and page == 2 or kind == "dead":
        raise OSError("no answer")
    if kind == "shaky" and random.random() < 0.5:
        raise OSError("try again")
    first = (page - 1) * 100
    return {"total": int(n), "matches": [{"ip_str": f"10.0.0.{i}"} for i in range(first, min(int(n), first + 100))] if page else []}
