"""The ten reports on random tables with nulls, blanks and repeats, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from laborscope.plans import QUERIES, JobDataset

KEYS = [None, "", " ", "\u2003"] + [f"k{i}" for i in range(40)]
COMPANIES = [None, "", "  ", "A", "B", " A", "a", "É", "\U0001f600"]
KINDS = [None, "", "Remote", "remote", " Remote"]
LEVELS = [None, "", "\t", "Senior", " Senior ", "Junior"]
SKILLS = [None, "", " ", "x", "x, y", "y, , x", ", ", "x,y", "\u2003x, y\u3000", "z, "]
TEXTS = [None, "", " ", "abc", "á\U0001f600", "l\nm"]


def first(rows):
    kept = {}
    for row in rows:
        kept.setdefault(row[0], row)
    return list(kept.values())


def text(value):
    return value is not None and value.strip() != ""


def items(value):
    return value.split(", ") if text(value) else []


def ranked(values, k=None):
    pairs = Counter(values).items()
    return sorted(pairs, key=lambda p: (-p[1], p[0].encode()))[:k]


def expected(postings, skills, summary, columns):
    unique = first(postings)
    first_skills = {r[0]: items(r[1]) for r in first(skills)}
    level = {r[0]: r[3] for r in unique}
    lengths = defaultdict(list)
    for key, body in summary:
        if key and body and text(level.get(key)):
            lengths[level[key]].append(len(body))
    companies = [r[1] for r in unique if text(r[1])]
    counts = [len(first_skills.get(r[0], [])) for r in unique]
    tokens = [t.strip() for words in first_skills.values() for t in words if t.strip()]
    dropped = sum(not text(r[0]) for r in postings)
    return {
        1: [(len(postings), len(unique), len(postings) - len(unique))],
        2: [
            (
                c,
                sum(r[i] is None for r in postings),
                sum(r[i] is not None and not text(r[i]) for r in postings),
                0,
                dropped,
            )
            for i, c in enumerate(columns)
        ],
        3: [(len(skills), sum(len(items(r[1])) for r in skills))],
        4: [(sum(r[2] == "Remote" for r in unique),)],
        5: ranked(companies, 10),
        6: ranked([r[4] for r in unique if text(r[4])], 10),
        7: [(k, len(v), pytest.approx(sum(v) / len(v), abs=0.005001)) for k, v in sorted(lengths.items())],
        8: ranked(tokens, 20),
        9: ranked(companies),
        10: [(len(unique), sum(n > 0 for n in counts), pytest.approx(sum(counts) / len(counts), abs=0.005001))],
    }


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, text_table, values, tmp_path, seed):
    rng = random.Random(seed)
    columns = ["job_link", "company", "job_type", "job_level", "search_country", "job_title"]
    choices = [KEYS, COMPANIES, KINDS, LEVELS, COMPANIES, ["t"]]
    postings = [tuple(rng.choice(c) for c in choices) for _ in range(150)]
    skills = [(rng.choice(KEYS), rng.choice(SKILLS)) for _ in range(120)]
    summary = [(rng.choice(KEYS), rng.choice(TEXTS)) for _ in range(200)]
    tables = {
        "postings": text_table(columns, postings),
        "skills": text_table(["job_link", "job_skills"], skills),
        "summary": text_table(["job_link", "job_summary"], summary),
    }
    for name, df in tables.items():
        for i in range(2):  # two files, in order
            half = df.filter(f"n >= {i * 75}" if i else "n < 75").orderBy("n").drop("n")
            half.coalesce(1).write.parquet(f"{tmp_path}/{name}/part{i}")
    data = JobDataset(spark, str(tmp_path), "postings/*", "skills/*", "summary/*")
    want = expected(postings, skills, summary, columns)
    for n in QUERIES:
        assert values(QUERIES[n](data).result) == want[n], n
