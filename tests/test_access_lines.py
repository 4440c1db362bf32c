"""The access-log parser against the plain pattern, on lines with odd characters."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.core import ACCESS_RE, parse_access

GOOD = '192.0.2.7 - u\x017 [26/Dec/2021:10:00:00 +0000] "GET /st/5 HTTP/1.1" 200 17'
LINES = [GOOD, GOOD + "\n more", 'a] - ]b [ x ] "G ]] HTTP" 404 1', "a ]b ]c ]d ]e ]f ]g ]h", "", "\x01" * 6, " ]" * 9, '- - [] "a b" 200 1', 'i - u [t\nt] "M p x" 500 9 tail ] ]', None]


def plain(line):
    m = re.match(ACCESS_RE, line) if line is not None else None
    return (m[1], m[2], m[4], m[5], int(m[6]), True) if m else ("", "", "", "", None, False)


def parsed(spark, lines):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    return [(r.p.ip, r.p.user, r.p.method, r.p.path, r.p.status, r.p.is_parsed) for r in rows.select("i", parse_access(F.col("line")).alias("p")).orderBy("i").collect()]


def test_odd_lines(spark):
    assert parsed(spark, LINES) == [plain(x) for x in LINES]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.from_regex(r'[a \]\x01]{1,3} - [a\x01\]]{1,3} \[[a \x01\n]{1,4}\] "[G\]] [/\]\x01]{1,2} [x ]?" [0-9]{2,3} [0-9] ?[ \]\n]*', fullmatch=True), min_size=1, max_size=60))
def test_lines_like_it(spark, lines):
    assert parsed(spark, lines) == [plain(x) for x in lines]
