"""Vectors, token counts and licences."""

import itertools
import math
import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import tokencount
from tidemark.llm.ann import hadamard, op6_nearest_vectors, search
from tidemark.llm.licences import spdx_licences
from tidemark.llm.licences import CUES, KNOWN, RULES, SENTENCES, cued, match_rules, normal, scan, sentence_ids
from tidemark.llm.tokencount import START, CountTrie, count_tokens, long_count, piece_scores, read_pieces

VECTORS = "vec_id long, embedding array<float>"
DOCS = "doc_id long, text string"


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_hadamard_is_orthogonal():
    h = hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(abs(h), 0.25)


def test_ties_and_rows_that_take_no_part(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(20, one), (7, one), (3, one), (5, [0.5, 0.5, 0.0]), (40, None), (60, [0.0, 0.0, 0.0])]
    rows += [(80, [float("nan"), 1.0, 0.0]), (100, [float("inf"), 1.0, 0.0]), (9, [None, 1.0, 0.0]), (11, [])]
    rows += [(None, one), (13, [1.0, 0.0]), (3, one)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x"))
    got = found(search(df, F.col("vec_id") % 20 == 0, probes=(6, 6, 6)))
    assert got == {20: [(1, 3, 1.0), (2, 7, 1.0), (3, 5, 0.5)]}
    top = found(search(df, F.col("vec_id") % 20 == 0, probes=(6, 6, 6), top=1))
    assert top == {20: [(1, 3, 1.0)]}
    assert search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_blocks_of_a_full_bucket(spark, monkeypatch):
    from tidemark.llm import ann

    monkeypatch.setattr(ann, "BLOCK", 16)
    rows = [(i, [1.0, 0.001 * (i % 7), 0.0, 0.0]) for i in range(300)]
    got = found(search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, probes=(8, 8, 8)))
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    for q, hits in got.items():
        score = (x * x[q]).sum(1)
        others = [i for i in range(300) if i != q]
        want = sorted(others, key=lambda i: (-score[i], i))[:20]
        assert [h[1] for h in hits] == want and [h[0] for h in hits] == list(range(1, 21))
    assert len(got) == 15


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    got = found(op6_nearest_vectors(spark, folder))
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = 0
    for q, best in got.items():
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits += len({ids[i] for i in np.lexsort((ids, -score))[:20]} & {b[1] for b in best})
        exact = dict(zip(ids.tolist(), score.tolist()))
        assert all(s == pytest.approx(exact[v], abs=1e-12) for _, v, s in best)
    assert len(got) == sum(ids % 20 == 0) and hits >= 0.9 * 20 * len(got)


def recall(got, x):
    hits = 0
    for q, best in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        want = np.argsort(-score, kind="stable")[: min(20, len(x) - 1)]
        assert len(best) == len(want)
        hits += len({*want.tolist()} & {b[1] for b in best}) / len(want)
    return hits / len(got)


@pytest.mark.parametrize("n, sigma, least", [(20, 0, 1), (41, 0, 0.9), (500, 0, 0.9), (500, 1, 0.9), (2000, 0, 0.9), (5000, 1, 0.95), (5000, 1.5, 0.95), (20000, 0, 0.9)])
def test_few_rows_and_uneven_lengths(spark, n, sigma, least):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x *= rng.lognormal(0, sigma, (n, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], VECTORS)
    got = found(search(df, (F.col("vec_id") % 20 == 0) & (F.col("vec_id") < 1000)))
    assert len(got) == min(50, -(-n // 20))
    assert recall(got, x.astype(float)) >= least


def compared(spark, n, dim):
    """Share of all (query, row) that the buckets bring together, each counted as often as it is compared."""
    from tidemark.llm import ann

    x = np.random.default_rng(7).normal(size=(n, dim)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], VECTORS)
    rows = ann.sized(df, "vec_id", "embedding")
    rows = rows.join(ann.lengths(rows), "dim")
    index, asked = ann.candidates(rows, rows.where("id % 20 = 0"), ann.TABLES, ann.PROBES)
    place = ["dim", "tab", "axis"]
    pairs = index.groupBy(place).count().join(asked.groupBy(place).agg(F.count(F.lit(1)).alias("q")), place)
    got = found(search(df, F.col("vec_id") % 500 == 0))
    return pairs.agg(F.sum(F.col("count") * F.col("q"))).first()[0] / (n * -(-n // 20)), recall(got, x.astype(float))


def test_more_rotations_compare_less_and_find_as_much(spark, monkeypatch):
    from tidemark.llm import ann

    monkeypatch.setattr(ann, "BLOCK", 32)
    # 32 signed axes: one rotation up to 1,024 vectors, then two.
    (few, found_few), (many, found_many) = compared(spark, 1000, 16), compared(spark, 6000, 16)
    assert many < 0.7 * few and min(found_few, found_many) >= 0.9


def test_probes_come_in_order_of_their_gaps():
    from tidemark.llm import ann

    x = np.random.default_rng(3).normal(size=(20, 8))
    codes = ann.buckets(x, 2, 2, 40)
    y = [np.stack((-r, r), 2).reshape(20, -1) for r in (ann.rotated(x, 2 * 3 + 1), ann.rotated(x, 2 * 3 + 2))]
    for row in range(20):
        cost = (y[0][row][:, None] + y[1][row][None, :]).ravel()
        got = cost[codes[row]]
        assert len(set(codes[row])) == 40 and (np.diff(got) >= -1e-12).all() and got[-1] <= np.sort(cost)[39] + 1e-9


def test_a_query_far_from_all_finds_all_it_can(spark, monkeypatch):
    from tidemark.llm import ann

    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(1)
    x = np.full((60, 16), 1.0) + rng.normal(size=(60, 16)) * 0.01
    x[0] = -x[0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.astype(np.float32).tolist())], VECTORS)
    got = found(search(df, F.col("vec_id") % 20 == 0, tables=1, probes=(1, 1, 1)))
    assert recall({0: got[0]}, x.astype(np.float32).astype(float)) == 1
    assert all(len(best) == 20 for best in got.values())


def brute_count(scores, byte, token):
    """The best of all ways to cut a token."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(token) - 1):
        parts, start = [], 0
        for i, cut in enumerate([*cuts, 1], 1):
            if cut:
                parts.append(token[start:i])
                start = i
        score, n = 0.0, 0
        for p in parts:
            if p in scores:
                score, n = score + scores[p], n + 1
            elif len(p) == 1:
                score, n = score + len(p.encode()) * byte, n + len(p.encode())
            else:
                break
        else:
            best = max(best or (-math.inf, 0), (score, -n))
    return -best[1]


def test_trie_counts_match_every_segmentation():
    rng = random.Random(2)
    pieces = [START, "a", "b", "ab", "ba", START + "a", "aba", "bb", START + "abb", "c", "é"]
    scores = piece_scores(pieces)
    trie = CountTrie(scores)
    for _ in range(300):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9)))
        want = brute_count(scores, trie.byte, START + word)
        assert trie.count(word.encode()) == want
        assert long_count(scores, trie.longest, trie.byte, START + word) == want
    assert trie.count(b"ab" * 500) == long_count(scores, trie.longest, trie.byte, START + "ab" * 500)


def test_a_small_trie_counts_the_same(monkeypatch):
    scores = piece_scores(["a", "b", "ab", START])
    words = ["".join(w).encode() for w in itertools.product("ab", repeat=6)]
    whole = CountTrie(scores)
    want = list(map(whole.count, words))
    monkeypatch.setattr(tokencount, "MAX_NODES", 10)
    small = CountTrie(scores)
    assert list(map(small.count, words)) == want and len(small.best) < 30


def test_prefixes_are_scored_once():
    trie = CountTrie(piece_scores(["a", "b"]))
    for word in (b"aab", b"aaa", b"aa"):
        trie.count(word)
    assert len(trie.best) == 1 + len({START, START + "a", START + "aa", START + "aab", START + "aaa"})


def test_token_counts_of_odd_rows(spark):
    rows = [(1, "the cat"), (1, "the cat"), (2, None), (3, ""), (4, " \n\t"), (None, "x" * 100_000), (5, "漢字  ")]
    got = count_tokens(spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("x")), read_pieces()).collect()
    assert sorted(((str(r.doc_id), r.n_pretokens) for r in got)) == [
        ("1", 2), ("1", 2), ("2", 0), ("3", 0), ("4", 0), ("5", 2), ("None", 1),
    ]
    scores = piece_scores(read_pieces())
    byte = CountTrie(scores).byte
    want = sum(long_count(scores, 16, byte, START + w) for w in ("the", "cat"))
    assert {r.n_tokens for r in got if r.doc_id == 1} == {want}
    assert count_tokens(spark.createDataFrame([], DOCS), read_pieces()).collect() == []
    with pytest.raises(ValueError):
        piece_scores(["x"] * (tokencount.MAX_PIECES + 1))


def test_sentences_and_rules_are_sound():
    assert all(i == "copyright" or (normal(t) == t and cued(t)) for t, i in KNOWN.items())
    assert all(set(ids) <= set(SENTENCES) for ids, _ in RULES)
    assert all(c == c.lower() for c in CUES)
    assert all(match_rules(ids) == ([name], []) for ids, name in RULES)


APACHE = """// Copyright (c) 2020 Some Body
// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
"""


@pytest.mark.parametrize(
    "text, ids, licences",
    [
        ("Some words. Released under the MIT License. More words.", ["mit-named"], ["MIT"]),
        ("no full stop here\nLicensed under CC BY-NC 4.0.", ["cc-by-nc"], ["CC-BY-NC-4.0"]),
        (APACHE, ["copyright", "apache-named", "apache-comply"], ["Apache-2.0"]),
        ("See our licence terms elsewhere.", ["unknown"], []),
        ("SPDX-License-Identifier: BSD-3-Clause", ["spdx-bsd-3"], ["BSD-3-Clause"]),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", ["spdx LGPL-2.1-or-later"], ["LGPL-2.1-or-later"]),
        ("/* SPDX-License-Identifier: Apache-2.0 OR MIT */\nint x;", ["spdx Apache-2.0", "spdx MIT"], ["Apache-2.0", "MIT"]),
        ("# SPDX-License-Identifier: MIT\n# and more", ["spdx-mit"], ["MIT"]),
        ("SPDX-License-Identifier: some licence or other", ["unknown"], []),
        ("nothing", [], []),
        ("", [], []),
        (None, [], []),
    ],
)
def test_licences(text, ids, licences):
    assert sentence_ids(text) == ids
    assert match_rules(ids)[0] == licences


GPL = """This program is free software{} you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation{} either version {} of the License, or (at
your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program{}"""
AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

"""
BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED."""
BSD_LIABILITY = """ IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
LGPL = GPL.replace("This program", "This library").replace("this program", "this library")
LGPL = LGPL.replace("General\nPublic", "General Public").replace("GNU General", "GNU Lesser General").replace("the GNU\nGeneral", "the GNU Lesser General")
AGPL = GPL.replace("GNU\nGeneral", "GNU Affero General").replace("GNU General", "GNU Affero General")
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
#: Notices as published, and the licence that each is.
NOTICES = [
    (GPL.format(";", ";", 2, "; if not, write to the Free Software Foundation, Inc."), "GPL-2.0-or-later"),
    (GPL.format(":", ",", 3, ". If not, see <https://www.gnu.org/licenses/>."), "GPL-3.0-or-later"),
    ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""", "Apache-2.0"),
    ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "MPL-2.0"),
    ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

""" + AS_IS + """ IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""", "MIT"),
    ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""", "ISC"),
    (BSD + BSD_WARRANTY, "BSD-2-Clause"),
    (BSD + BSD_3 + BSD_WARRANTY, "BSD-3-Clause"),
    (BSD + BSD_WARRANTY + BSD_LIABILITY, "BSD-2-Clause"),
    (BSD + BSD_3 + BSD_WARRANTY + BSD_LIABILITY, "BSD-3-Clause"),
    ("All rights reserved.\n\n" + BSD + BSD_3 + BSD_WARRANTY + BSD_LIABILITY, "BSD-3-Clause"),
    (LGPL.format(";", ";", "2.1", "; if not, write to the Free Software Foundation, Inc."), "LGPL-2.1-or-later"),
    (LGPL.format(":", ",", 3, ". If not, see <https://www.gnu.org/licenses/>."), "LGPL-3.0-or-later"),
    (AGPL.format(":", ",", 3, ". If not, see <https://www.gnu.org/licenses/>."), "AGPL-3.0-or-later"),
    (BOOST, "BSL-1.0"),
    ("""Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)""", "BSL-1.0"),
    ("""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""", "Zlib"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
]


def wrapped(text, mark, width):
    lines = []
    for part in text.split("\n\n"):
        lines += [*textwrap.wrap(part, width, break_long_words=False, break_on_hyphens=False), ""]
    return "\n".join(f"{mark}{line}".rstrip() for line in lines)


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", ";; ", "-- "])
@pytest.mark.parametrize("width", [10_000, 76, 24, 1])
def test_published_notices(mark, width):
    for text, licence in NOTICES:
        ids = sentence_ids(wrapped(text, mark, width))
        assert (ids, licence) in RULES
        assert match_rules(ids) == ([licence], [])
    for text, name in KNOWN.items():
        assert sentence_ids(wrapped(text, mark, width)) == [name] or name == "copyright"


def test_a_whole_bsd_file_is_one_licence():
    text = "Copyright (c) 2020, Some Body\nAll rights reserved.\n\n" + BSD + BSD_3 + BSD_WARRANTY + BSD_LIABILITY
    assert match_rules(sentence_ids(text)) == (["BSD-3-Clause"], [])
    assert match_rules(["copyright", "rights-reserved"]) == (["proprietary"], ["copyright"])


@pytest.mark.parametrize(
    "expression, licences",
    [
        ("MIT", ["MIT"]),
        ("(MIT OR Apache-2.0) AND BSD-3-Clause", ["MIT", "Apache-2.0", "BSD-3-Clause"]),
        ("GPL-2.0+ WITH Classpath-exception-2.0 or MIT", ["GPL-2.0+ WITH Classpath-exception-2.0", "MIT"]),
        ("((MIT))", ["MIT"]),
        ("MIT -->", ["MIT"]),
        ("MIT OR", []),
        ("(MIT", []),
        ("MIT)", []),
        ("MIT Apache-2.0", []),
        ("MIT WITH (x)", []),
        ("OR", []),
        ("", []),
    ],
)
def test_spdx_expressions(expression, licences):
    assert spdx_licences(f" * SPDX-License-Identifier: {expression}") == licences


def test_semicolons_part_what_is_not_known():
    text = "Copyright 2020 A Body; licensed under the MIT license; see our licence; and permission terms."
    assert sentence_ids(text) == ["copyright", "mit-named", "unknown", "unknown"]


def test_longer_rules_win():
    grant = ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]
    assert match_rules([*grant, "unknown", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]) == (
        ["MIT", "BSD-3-Clause"],
        ["unknown"],
    )
    assert match_rules(["mit-named", "mit-named", "copyright"]) == (["MIT"], ["copyright"])


def test_scan_answers_every_row(spark):
    rows = [(1, "MIT License"), (1, "MIT License"), (2, None), (None, "All rights reserved."), (3, "x\n" * 50_000)]
    got = scan(spark.createDataFrame(rows, DOCS).withColumn("licences", F.lit(1))).collect()
    assert sorted((str(r.doc_id), list(r.licences)) for r in got) == [
        ("1", ["MIT"]), ("1", ["MIT"]), ("2", []), ("3", []), ("None", ["proprietary"]),
    ]
    assert scan(spark.createDataFrame([], DOCS)).collect() == []
