"""Operators against direct Python versions of the rules, on random inputs."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)),
                min_size=1, max_size=25, unique_by=lambda r: (r[0], r[2])))
def test_latest_by_equals_python(spark, rows):
    from seqlake.operators.latest import latest_by
    df = spark.createDataFrame(rows, "k string, t int, tb int")
    got = {(r["k"], r["t"], r["tb"]) for r in latest_by(df, ["k"], ["t"], ["tb"]).collect()}
    want = set()
    for k in {r[0] for r in rows}:
        grp = [r for r in rows if r[0] == k]
        # newest time first (a missing time never wins), then the smallest tie-break
        best = min(grp, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want.add(best)
    assert got == want


def _pairs_python(rows):
    """Per sample: first R1 file by (name, uri); its mate is the name with
    R1 -> R2; both URIs are the first of their name."""
    out = {}
    reads = [r for r in rows if re.fullmatch(r".*_R[12].*.fastq.gz", r[1]) and r[0] != "null"]
    for k in {r[0] for r in reads}:
        grp = sorted((f, u) for kk, f, u in reads if kk == k)
        firsts = [x for x in grp if re.fullmatch(r".*_R1.*.fastq.gz", x[0])]
        if not firsts:
            continue
        f1, u1 = firsts[0]
        mate = f1.replace("R1", "R2")
        mates = [u for f, u in grp if f == mate]
        if mates:
            out[k] = (u1, mates[0])
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "null"]),
                          st.sampled_from(["A_R1_001.fastq.gz", "A_R2_001.fastq.gz", "B_R1.fastq.gz",
                                           "xR1_R1.fastq.gz", "xR2_R2.fastq.gz", "A_R1.bam", "A_R2.fastq.gz"]),
                          st.sampled_from(["s3://u/1", "s3://u/2", "s3://u/3"])), min_size=1, max_size=20))
def test_read_pairs_equals_python(spark, rows):
    from seqlake.operators.pairs import read_pairs
    df = spark.createDataFrame(rows, "id_alt string, file string, current string")
    got = {r["id_alt"]: (r["fastq_1"], r["fastq_2"]) for r in read_pairs(df).collect()}
    assert got == _pairs_python(rows)


def _infer_python(files, samples, mode):
    out = set()
    names = [s for s, _ in sorted(samples, key=lambda x: x[1])]
    order = names if mode == "reference" else sorted(names, key=lambda n: (-len(n), names.index(n)))
    for f in set(files):
        found = [s for s in names if s in f]
        if (mode == "reference" and len(found) < len(set(names))) or (mode == "disjoint" and not found):
            out.add(("run_files", f))
        if found:
            p = f
            for s in order:          # the lab folds over every sample of the manifest, in order
                p = p.replace(s, "<sample>")
            out.add(("sample_files", p))
    return out


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="XY01/_.", min_size=1, max_size=9), min_size=1, max_size=8),
       st.lists(st.text(alphabet="XY01", min_size=1, max_size=3), min_size=1, max_size=4, unique=True),
       st.sampled_from(["reference", "disjoint"]))
def test_infer_rules_equals_nested_loop(spark, files, names, mode):
    from seqlake.operators.retention import infer_rules
    samples = [(s, i) for i, s in enumerate(names)]
    f = spark.createDataFrame([("r", p) for p in files], "run string, rel string")
    s = spark.createDataFrame([("r", n, i) for n, i in samples], "run string, sample string, ord long")
    got = {(r["kind"], r["pattern"]) for r in infer_rules(f, s, mode).collect()}
    assert got == _infer_python(files, samples, mode)
