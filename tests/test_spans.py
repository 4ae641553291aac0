import random
from datetime import date, timedelta

from harborlens.operators.spans import periods

SCHEMA = "ip string, port int, first_seen date, last_seen date, days_observed bigint, kind string"


def brute(cases):
    days = {}
    for ip, port, a, b, n, _ in cases:
        if a and b and a <= b and n and n >= 1:
            days.setdefault((ip, port), set()).update(range(a.toordinal(), b.toordinal() + 1))
    out = []
    for (ip, port), covered in days.items():
        covered = sorted(covered)
        runs = []
        for d in covered:
            if runs and runs[-1][1] == d - 1:
                runs[-1][1] = d
            else:
                runs.append([d, d])
        out += [(ip, port, "period", date.fromordinal(a), date.fromordinal(b)) for a, b in runs]
        out += [(ip, port, "gap", date.fromordinal(x[1] + 1), date.fromordinal(y[0] - 1)) for x, y in zip(runs, runs[1:])]
    return sorted(out, key=repr)


def test_against_brute_force(spark, rows):
    rng = random.Random(1)
    cases = []
    for _ in range(600):
        start = date(2024, 1, 1) + timedelta(days=rng.randrange(400))
        cases.append((rng.choice("abc"), rng.choice([1, 2, None]), start, start + timedelta(days=rng.choice([0, 0, 1, 2, 7, 40, -1])), rng.choice([1, 5, 0, None]), "clash"))
    cases += cases[:50] + [("d", 1, None, date(2024, 1, 1), 1, ""), ("e", 1, date(1, 1, 1), date(9999, 12, 31), 1, ""), ("f", 1, date(1969, 12, 30), date(1970, 1, 2), 1, "")]
    got = periods(spark.createDataFrame(cases, SCHEMA), ["ip", "port"])
    assert got.columns == ["ip", "port", "kind", "from_day", "to_day"]
    assert rows(got) == brute(cases)


def test_empty_and_hot_entity(spark, rows):
    assert periods(spark.createDataFrame([], SCHEMA), ["ip", "port"]).isEmpty()
    hot = spark.range(20000).selectExpr("'a' as ip", "1 as port", "date_add(date'2024-01-01', cast(id % 700 as int)) as first_seen", "date_add(date'2024-01-01', cast(id % 700 as int)) as last_seen", "1L as days_observed")
    assert rows(periods(hot, ["ip", "port"])) == [("a", 1, "period", date(2024, 1, 1), date(2025, 11, 30))]
