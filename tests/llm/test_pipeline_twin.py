"""The corpus pipeline against a plain-Python version of its five stages."""

import collections
import re
import zlib

import corpus_pipeline
from test_document_operators import SMALL, brute_repeats, packed_ids
from test_near_dedup import kept

from matchlens.llm.host_rules import Limits

BLANK = r"\x20\x09-\x0D"


def judged(text, limits):
    """Whether a text fails the base rules, and whether it fails any rule."""
    words = re.findall(f"[^{BLANK}]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    base = len(words) < limits.min_words or 100 * len(covered) > limits.repeat_percent * len(words)
    symbols = 100 * len(re.findall(r"[#*$%&|<>]", text)) > limits.symbol_percent * sum(map(len, words))
    return base, base or symbols or len(lines) - len(set(lines)) >= limits.dup_lines


def quality(rows, limits=Limits()):
    verdicts = {i: judged(text, limits) for i, text, _ in rows}
    hosts = collections.defaultdict(list)
    for i, _, host in rows:
        if host is not None:
            hosts[host].append(verdicts[i][1])
    n = sum(map(len, hosts.values()))
    mean = sum(map(sum, hosts.values())) / n
    variance = sum(len(f) * (sum(f) / len(f)) ** 2 for f in hosts.values()) / n - mean**2
    strength = min(max(mean * (1 - mean) / variance - 1, 1.0), 1000.0) if variance > 1e-12 else 1000.0
    bad = set()
    for host, failed in hosts.items():
        total = strength + len(failed)
        rate = (mean * strength + sum(failed)) / total
        if rate - limits.deviations * (rate * (1 - rate) / (total + 1)) ** 0.5 > limits.max_host_rate:
            bad.add(host)
    return [(i, text) for i, text, host in rows if not verdicts[i][0] and host not in bad]


def without_lines(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(f"^[{BLANK}]+|[{BLANK}]+\\Z", "", line))
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in text.split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(k) >= 20 and len(ids) >= 3}
    return [(i, "\n".join(x for x in text.split("\n") if gone.get(key(x), i) == i)) for i, text in rows]


def pieces(rows):
    for i, ids in packed_ids(dict(rows)).items():
        first = (len(ids) - 1) % 1024 + 1
        for piece, end in enumerate(range(first, len(ids) + 1, 1024)):
            start = max(0, end - 1024) if piece else 0
            yield i, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())


def test_pipeline_equals_its_plain_version(spark):
    table = [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    good = quality(table)
    lines = without_lines(good)
    stay = set(kept(lines))
    single = [r for r in lines if r[0] in stay]
    cut = [(i, b.decode(errors="ignore")) for (i, _), (*_, b) in zip(single, brute_repeats([t.encode() for _, t in single]))]
    # Every stage has something to do on this table.
    assert len(table) > len(good) == len(lines) > len(single) and good != lines and single != cut

    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(pieces(cut))
    bins = collections.defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.02 * -(-sum(r.length for r in found) // 1024) + 2
