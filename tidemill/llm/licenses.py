"""Licence scans: a trained paragraph classifier with template confirmation, by DataFrame functions and Spark ML alone.

Texts are cut into paragraphs (lines, and sentences within them). A template confirms a paragraph when enough of the
shorter's word 2-grams are shared (CONFIRM); paragraphs with too few 2-grams of all templates together for any of them are
unknown without more ado, as none could confirm them: the test is derived from the templates and loses nothing. The
others are kept once each, however many documents repeat them. Sparse word 1- and 2-grams feed a multinomial logistic
regression over licence families and an unknown class. It is trained on the templates, on parts of them and on variants that drop
words, against the notices of `NEAR` and a bounded sample of the corpus's hardest unknowns: at most MAX_UNKNOWN different
paragraphs that share 2-grams with templates but that none confirms (the half by hash of all of them, those with the least hash). SPDX lines
are notices of their own. The cut for the unknown class is calibrated on all of the other half: the CUT_QUANTILE of their family probability, within CUT_RANGE. A
prediction counts when it passes the cut and a template of its family confirms it.

Defined cases: null and empty texts have no paragraph and no licence. Every row gives a row, judged by its own text, also where ids
repeat. Very long texts are scanned whole. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import hot_keys, order_hash, spread_join, written

MAX_UNKNOWN = 2000
CUT_QUANTILE = 0.99
CUT_RANGE = (0.3, 0.6)
CONFIRM = 0.6
PARAGRAPH = r"\n+|(?<=[.!?;])\s+"
_TOKEN = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"

#: The notices by which each family is announced and the sentences of short licences, as they word them.
TEMPLATES = {
    "agpl": [
        "licensed under the gnu affero general public license version 3",
        "under the terms of the gnu affero general public license as published by the free software foundation",
        "you should have received a copy of the gnu affero general public license along with this program",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license",
        "you may obtain a copy of the license at http www apache org licenses license 2.0",
        "released under the apache 2.0 license",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "see the license for the specific language governing permissions and limitations under the license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistributions of source code must retain the above copyright notice",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
        "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages",
        "released under the bsd license",
        "licensed under the 3 clause bsd license",
    ],
    "bsl-1.0": [
        "distributed under the boost software license version 1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    ],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4.0", "this work is licensed under a creative commons attribution noderivatives 4.0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights", "released under cc 0 1.0 universal public domain dedication"],
    "epl-2.0": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2.0", "licensed under the eclipse public license version 2.0"],
    "gpl": [
        "licensed under the gnu general public license version 3",
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
        "you should have received a copy of the gnu general public license along with this program",
        "released under the gpl license version 2",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits",
        "released under the isc license",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 2.1",
        "under the terms of the gnu lesser general public license",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license 2.0",
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0",
    ],
    "odbl": ["this database is made available under the open database license"],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "released under the unlicense",
    ],
    "wtfpl": ["do what the fuck you want to public license"],
    "zlib": [
        "this software is provided as is without any express or implied warranty",
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
        "this notice may not be removed or altered from any source distribution",
        "released under the zlib license",
    ],
}
#: The identifiers that an SPDX line may name for each family, as words.
SPDX = {
    "agpl": ["agpl 3.0", "agpl 3.0 only", "agpl 3.0 or later"], "apache-2.0": ["apache 2.0"], "bsd": ["bsd 2 clause", "bsd 3 clause"], "bsl-1.0": ["bsl 1.0"],
    "cc-by": ["cc by 4.0"], "cc-by-nc": ["cc by nc 4.0"], "cc-by-nd": ["cc by nd 4.0"], "cc-by-sa": ["cc by sa 4.0"], "cc0": ["cc 0 1.0"], "epl-2.0": ["epl 2.0"],
    "gpl": ["gpl 2.0", "gpl 2.0 only", "gpl 2.0 or later", "gpl 3.0 only", "gpl 3.0 or later"], "isc": ["isc"], "lgpl": ["lgpl 2.1", "lgpl 2.1 only", "lgpl 2.1 or later", "lgpl 3.0 only"],
    "mit": ["mit"], "mpl": ["mpl 2.0"], "odbl": ["odbl 1.0"], "unlicense": ["unlicense"], "wtfpl": ["wtfpl"], "zlib": ["zlib"],
}
for _family, _ids in SPDX.items():
    TEMPLATES[_family] += [f"spdx license identifier {i}" for i in _ids]
#: Wordings near to notices that name no family.
NEAR = ["spdx license identifier none", "spdx license identifier proprietary", "the spdx license list", "a license identifier is missing", "all rights reserved", "see the license file for details", "a driver license is required", "the license of this work is unknown", "licensed under the terms of the agreement", "released under the new name", "version 2.0 was released", "the general public is free to use this", "permission was granted by the city", "this work is under the water", "copyright belongs to the author", "this software is free of charge"]


def _grams(words: Column | str) -> str:
    return f"concat({words}, if(size({words}) > 1, transform(sequence(0, size({words}) - 2), i -> concat({words}[i], ' ', {words}[i + 1])), cast(array() as array<string>)))"


def _pairs(words: str) -> str:
    return f"filter(array_distinct({_grams(words)}), g -> contains(g, ' '))"


def _template_pairs() -> list[str]:
    return sorted({" ".join(w[i : i + 2]) for ts in TEMPLATES.values() for t in ts for w in [t.split()] for i in range(len(w) - 1)})


def _cover(pairs: list[str]) -> list[str]:
    """Words of which every 2-gram holds at least one; long words rather than short ones, which texts are full of."""
    left, out = {tuple(p.split()) for p in pairs}, []
    while left:
        out.append(max(sorted({w for p in left for w in p}), key=lambda w: (len(w), sum(w in p for p in left))))
        left = {p for p in left if out[-1] not in p}
    return out


def _least_pairs() -> int:
    return min(len({tuple(w[i : i + 2]) for i in range(len(w) - 1)}) for ts in TEMPLATES.values() for t in ts for w in [t.split()])


def may_confirm(words: Column) -> Column:
    """Whether a paragraph's 2-grams hold as many of any templates' as the least demanding template asks for."""
    known = _template_pairs()
    own = F.array_distinct(F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1))))
    enough = lambda o: F.size(F.filter(o, lambda g: g.isin(known))) >= CONFIRM * F.greatest(F.least(F.size(o), F.lit(_least_pairs())), F.lit(2))
    return F.when(F.size(words) > 1, F.get(F.transform(F.array(own), enough), F.lit(0))).otherwise(False)


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number), doc_id and the paragraphs, as arrays of words, that hold a word of some template's every 2-gram."""
    words = f"transform(split(lower(cast({text_col} as string)), r'{PARAGRAPH}'), p -> regexp_extract_all(p, r'{_TOKEN}', 0))"
    # Words are made once, within the array.
    some = _cover(_template_pairs())
    found = F.filter(F.expr(words), lambda w: F.exists(w, lambda x: x.isin(some)))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(found, F.array().cast("array<array<string>>")).alias("found"))


def distinct_paragraphs(lines: DataFrame) -> DataFrame:
    """key, words, n, shares (by family, in order): each different paragraph that a template might confirm."""
    families = [F.greatest(*[_share([" ".join(w[i : i + 2]) for i in range(len(w) - 1)]) for t in ts for w in [t.split()]], F.lit(0.0)) for _, ts in sorted(TEMPLATES.items())]
    rows = lines.groupBy("key").agg(F.first("words").alias("words"), F.count("*").alias("n"))
    return rows.withColumn("own", F.expr(_pairs("words"))).select("key", "words", "n", F.array(*families).alias("shares"))


def _template_rows(spark) -> DataFrame:
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    return spark.createDataFrame(rows, "family string, t string").select("family", F.expr(f"regexp_extract_all(t, '{_TOKEN.replace(chr(92), chr(92) * 2)}', 0)").alias("words"))


def _examples(spark) -> DataFrame:
    """(label, words): whole templates, the halves of long ones, and variants without every third word or with words around."""
    rows = _template_rows(spark)
    cuts = F.expr(
        """array(words, slice(words, 1, int(greatest(6, size(words) * 2 / 3))), if(size(words) > 9, slice(words, int(size(words) / 2), size(words)), words),
        filter(words, (w, i) -> i % 3 <> 1 or size(words) < 7), filter(words, (w, i) -> i % 4 <> 2 or size(words) < 7), concat(array('the'), words), concat(words, array('see', 'here')), concat(array('this', 'is'), words))"""
    )
    near = spark.createDataFrame([(t,) for t in NEAR], "t string").select(F.lit("unknown").alias("family"), F.split("t", " ").alias("words"))
    return rows.select("family", F.explode(cuts).alias("words")).unionByName(near)


def _featured(df: DataFrame) -> DataFrame:
    vocabulary = sorted({g for ts in TEMPLATES.values() for t in ts for w in [t.split()] for g in [*w, *(" ".join(w[i : i + 2]) for i in range(len(w) - 1))]})
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    return counter.transform(df.withColumn("grams", F.expr(_grams("words"))))


def _family_chances(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """`rows` with p: the probability of each family, in order."""
    return model.transform(_featured(rows)).withColumn("p", F.slice(vector_to_array("probability"), 2, len(TEMPLATES))).select(*rows.columns, "p")


def teach(found: DataFrame, max_unknown: int = MAX_UNKNOWN) -> tuple[LogisticRegressionModel, float]:
    """The classifier and the cut, from distinct paragraphs."""
    unknown = found.filter(F.array_max("shares") < CONFIRM).withColumn("draw", order_hash("key", seed="unknown"))
    half = F.pmod("draw", F.lit(2)) == 0
    names = F.array(*map(F.lit, ["unknown", *sorted(TEMPLATES)]))
    sample = unknown.filter(half).orderBy("draw", "key").limit(max_unknown).select(F.lit("unknown").alias("family"), "words")
    examples = _examples(found.sparkSession).unionByName(sample).withColumn("label", F.array_position(names, F.col("family")).cast("double") - 1)
    rows = written(_featured(examples).select("label", "features").coalesce(1), "examples")
    model = LogisticRegression(regParam=0.002, elasticNetParam=0.0, maxIter=40, family="multinomial", standardization=False).fit(rows)
    hard = _family_chances(model, unknown.filter(~half).select("words")).agg(F.percentile_approx(F.array_max("p"), CUT_QUANTILE, 10_000)).first()[0]
    return model, min(max(hard or 0.0, CUT_RANGE[0]), CUT_RANGE[1])


def hits(found: DataFrame, model: LogisticRegressionModel, cut: float) -> DataFrame:
    """key, family, score of the distinct paragraphs that pass the cut and are confirmed."""
    likely = _family_chances(model, found.filter(F.array_max("shares") >= CONFIRM)).withColumn("score", F.array_max("p"))
    at = F.array_position("p", F.col("score")).cast("int")
    likely = likely.filter((F.col("score") >= cut) & (F.element_at("shares", at) >= CONFIRM))
    return likely.select("key", F.element_at(F.array(*map(F.lit, sorted(TEMPLATES))), at).alias("family"), "score")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_hits, licences (sorted families, comma-joined), score (highest family probability) for every row."""
    rows = paragraphs(docs, id_col, text_col)
    rows = written(rows.withColumn("found", F.filter("found", may_confirm)), "paragraphs")
    lines = rows.select("row", F.explode("found").alias("words")).withColumn("key", F.md5(F.array_join("words", " ").cast("binary")))
    found = written(distinct_paragraphs(lines), "distinct")
    known = written(hits(found, *teach(found)), "hits")
    hot = hot_keys(found, "key", "n")  # a notice that very many documents repeat
    named = spread_join(lines.select("row", "key"), known, "key", hot, "inner")
    named = named.groupBy("row").agg(F.count("*").alias("n_hits"), F.array_join(F.sort_array(F.collect_set("family")), ",").alias("licences"), F.max("score").alias("score"))
    return rows.select("row", "doc_id").join(named, "row", "left").select("doc_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _share(template: list[str]) -> Column:
    """The share of the shorter's 2-grams that a paragraph and a template have in common."""
    both = F.size(F.array_intersect("own", F.array(*map(F.lit, template))))
    return both / F.greatest(F.least(F.size("own"), F.lit(len(template))), F.lit(2))
