"""Licence scans: a paragraph classifier over word n-grams, confirmed by templates.

Paragraphs are separated by blank lines; line ends inside one count as spaces.  One that holds a
cue word is scored by multinomial logistic regression over hashed words and word pairs; the cue
words meet every word triple of every template, so no other paragraph can be confirmed.  The
classes are licence families and "unknown".  Probabilities
are calibrated by a temperature fitted on held-out texts, and a family needs ``LEAST`` of
probability.  It must also be confirmed: enough of the paragraph's word triples, or of one
template's, occur in both; texts of one or two words count whole.  A paragraph is scored in
overlapping windows of ``WINDOW`` words, so that notices inside long ones are seen, and confirmed
as a whole.  Scanning uses Spark's built-in functions only.

The model is small and trained on the driver from the fixed templates and counter-examples
below, each varied ``VARIANTS`` times with a fixed seed; nothing is read from the corpus.

Null or empty texts have no paragraphs and family "none"; so has a text without cue words.
A text whose scored paragraphs are all unknown has family "unknown".  Rows are judged one by
one, whatever their ids; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES, VARIANTS, NAMED, HELD_OUT = 4096, 48, 4, 0.25
LEAST, SHARED = 0.6, 0.5
WINDOW, AROUND = 24, 18
MENTION = r"(?i)licen[sc]|lizen[zs]|copyright|permission|redistribut|warrant|public domain|creative ?commons|\bcc[ -]by|\bcc0"

# Short notices of the families, as their publishers word them, and other texts.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "MIT License",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
}
# Names of the families, and how notices in the languages of documents lead to them.
NAMES = {
    "apache-2.0": ("Apache 2.0", "Apache-2.0", "Apache License 2.0"),
    "mit": ("MIT",),
    "gpl-3.0": ("GPLv3", "GPL v3", "GPL 3.0", "GNU GPL v3", "GNU GPLv3", "GNU General Public License v3"),
    "lgpl": ("LGPL", "LGPLv3", "LGPL 2.1", "GNU LGPL"),
    "bsd": ("BSD", "BSD 3-Clause", "BSD 2-Clause"),
    "mpl-2.0": ("MPL 2.0", "MPLv2", "Mozilla Public License 2.0"),
    "cc-by-nc-4.0": ("CC BY-NC 4.0", "Creative Commons BY-NC 4.0"),
    "cc-by-4.0": ("CC BY 4.0", "Creative Commons BY 4.0"),
}
# Every word triple of these holds a word of the name.
LEADS = (
    "under the {}", "under the {} license", "under the {} licence", "licensed under {}", "released under {}", "distributed under {}",
    "unter der {}", "unter der {} Lizenz", "lizenziert unter {}", "veröffentlicht unter {}",
    "sous la {}", "sous licence {}", "sous la licence {}", "publié sous {}", "distribué sous {}",
    "bajo la {}", "bajo licencia {}", "bajo la licencia {}", "publicado bajo {}", "distribuido bajo {}",
    "{} License", "{} Licence", "{} Lizenz", "licence {}", "licencia {}",
)
COMMON = frozenset("a an and any are as at be by for free from in is it may not of on or out that the this to with without you your file use part under unter der sous la bajo mit".split())
UNKNOWN = (
    "All rights reserved. No part of this publication may be reproduced without the prior permission of the publisher.",
    "Copyright of the photographs remains with their authors.",
    "He lost his driving licence after the accident and asked for permission to drive again.",
    "The committee granted the station a licence to broadcast for another ten years.",
    "Fishing without a license is not permitted in this part of the river.",
    "The software license must be renewed every year by the customer.",
    "This document is licensed to the named user and may not be shared.",
    "Use of this site is subject to our terms of service and privacy policy.",
    "There is no warranty on used cars sold by private persons.",
    "The company makes no warranty as to the accuracy of the information.",
    "They discussed the copyright law and the public domain in the afternoon.",
    "A license plate was found near the version of the bridge that fell down.",
    "The terms of the agreement were published by the foundation in two versions.",
    "The general public was free to copy the notes of the meeting.",
    "Files may be used in compliance with the rules of the library.",
)
# Other licences, which differ from a template by a word or two, and other uses of its words; never cut, which could make them equal.
OTHERS = (
    "Licensed under the GNU General Public License, version 2.",
    "SPDX-License-Identifier: GPL-2.0-only",
    "SPDX-License-Identifier: Zlib",
    "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY-ND 4.0.",
    "Licensed under the Apache License, Version 1.1.",
    "Released under the terms of the agreement between the authors and the publisher.",
    "Distributed under GPLv2.",
    "Lizenziert unter CC BY-SA 4.0.",
    "Publié sous licence CC BY-SA 4.0.",
    "Publicado bajo la licencia CC BY-ND 4.0.",
    "Die Lizenz des Senders wurde unter der neuen Leitung verlängert.",
    "Elle a perdu la licence de la station et la permission de publier sous la marque.",
    "La licencia de conducir fue renovada bajo la ley nueva.",
    "He studied at MIT under the direction of a professor and left for the Apache reservation.",
)


class Model(NamedTuple):
    families: list[str]
    weights: np.ndarray  # families x features
    bias: np.ndarray
    temperature: float
    held_out_accuracy: float


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _templates() -> dict[str, list[str]]:
    """Notices and names of each family."""
    return {f: [*ts, *(lead.format(n) for n in NAMES[f] for lead in LEADS), *(n for n in NAMES[f] if re.search("[0-9]", n))] for f, ts in TEMPLATES.items()}


def _features(words: list[str]) -> list[int]:
    grams = set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}
    return sorted({zlib.crc32(g.encode()) % FEATURES for g in grams})


def _varied(text: str, cut: bool, rng: np.random.Generator) -> list[str]:
    """The words of a text, perhaps cut at one end and with some left out, and other words on both sides."""
    words = _words(text)
    keep = max(3, int(len(words) * rng.uniform(0.6, 1))) if cut else len(words)
    first = int(rng.integers(0, len(words) - keep + 1)) if len(words) > keep else 0
    words = [w for w in words[first : first + keep] if not cut or rng.random() > 0.05]
    # ordinary and invented words, as many as a window holds besides
    other = [w for k in rng.integers(len(UNKNOWN), size=2) for w in _words(UNKNOWN[k])]
    other = [f"w{rng.integers(10**6)}" if rng.random() < 0.5 else w for w in other[: int(rng.integers(0, AROUND))]]
    at = int(rng.integers(0, len(other) + 1))
    return other[:at] + words + other[at:]


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@lru_cache(maxsize=1)
def trained(steps: int = 600, rate: float = 2.0, ridge: float = 1e-4, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    families = ["unknown", *TEMPLATES]
    texts = [(0, t) for t in (*UNKNOWN, *OTHERS)] + [(families.index(f), t) for f, ts in TEMPLATES.items() for t in ts]
    named = [(families.index(f), t) for f, ts in _templates().items() for t in ts if t not in TEMPLATES[f]]
    varied = [(c, t, t not in OTHERS) for c, t in texts for _ in range(VARIANTS)] + [(c, t, False) for c, t in named for _ in range(NAMED)]
    texts += named
    rows = [(c, _words(t)) for c, t in texts] + [(c, _varied(t, cut, rng)) for c, t, cut in varied]
    x, y = np.zeros((len(rows), FEATURES), np.float32), np.array([c for c, _ in rows])
    for i, (_, words) in enumerate(rows):
        x[i, _features(words)] = 1 / np.sqrt(max(len(words), 1))
    held = rng.random(len(rows)) < HELD_OUT
    held[: len(texts)] = False
    hot, seen = np.eye(len(families), dtype=np.float32)[y][~held], x[~held]
    w, b = np.zeros((FEATURES, len(families)), np.float32), np.zeros(len(families), np.float32)
    for _ in range(steps):
        error = (_softmax(seen @ w + b) - hot) / len(seen)
        w -= rate * len(families) * (seen.T @ error + ridge * w)
        b -= rate * error.sum(0)
    scores = x[held] @ w + b

    def loss(t: float) -> float:
        return float(-np.log(_softmax(scores / t)[np.arange(held.sum()), y[held]] + 1e-12).mean())

    temperature = min(np.geomspace(0.05, 5, 60).tolist(), key=loss)
    return Model(families, w.T.astype(float), b.astype(float), temperature, float((scores.argmax(1) == y[held]).mean()))


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _grams(words: Column, n: int) -> Column:
    return F.when(F.size(words) < n, F.slice(words, 1, 0)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
    )


def _triples(words: list[str]) -> list[str]:
    """The word triples of a text, or all of a shorter one."""
    return sorted({" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))})


@lru_cache(maxsize=1)
def _cues() -> tuple[list[str], list[str]]:
    """Words that meet the triples of the templates, the most frequent first, and the triples of common words and numbers only."""
    left = {g for ts in _templates().values() for t in ts for g in _triples(_words(t))}
    phrases = {g for g in left if all(w in COMMON or w.isdigit() for w in g.split(" "))}
    left, cues = [set(g.split(" ")) for g in left - phrases], []
    while left:
        times = Counter(w for g in left for w in g if not (w in COMMON or w.isdigit()))
        cues.append(min(times, key=lambda w: (-times[w], w)))
        left = [g for g in left if cues[-1] not in g]
    return cues, sorted(phrases)


def _cued(words: Column) -> Column:
    """Whether the words hold a cue; so do all that share a triple with a template."""
    cues, phrases = _cues()
    return F.arrays_overlap(words, _literal(cues, "array<string>")) | F.rlike(F.array_join(words, " "), F.lit(rf"(?<!\S)(?:{'|'.join(phrases)})(?!\S)"))


def _windows(words: Column) -> Column:
    """Windows of WINDOW words that overlap by half; all of a shorter text."""
    step = WINDOW // 2
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - step, F.lit(1)), F.lit(step)), lambda i: F.slice(words, i, WINDOW))


def _scored(paragraph: Column, model: Model) -> Column:
    """(confirmed, probability, family) of one paragraph: of its best confirmed window, or else its best one."""
    weights = _literal(np.round(model.weights, 6).tolist(), "array<array<double>>")
    bias = _literal(model.bias.tolist(), "array<double>")
    templates = [[_triples(_words(t)) for t in ts] for ts in _templates().values()]
    every = _literal([[], *templates], "array<array<array<string>>>")
    known = _literal([[], *(sorted({g for t in ts for g in t}) for ts in templates)], "array<array<string>>")
    names = _literal(model.families, "array<string>")

    def judge(words: Column) -> Column:
        hashed = F.array_distinct(F.transform(F.array_union(words, _grams(words, 2)), lambda g: (F.crc32(g) % FEATURES).cast("int")))

        def probabilities(features: Column) -> Column:
            scale = F.sqrt(F.greatest(F.size(words), F.lit(1)).cast("double"))
            scores = F.zip_with(weights, bias, lambda w, b: (b + F.aggregate(features, F.lit(0.0), lambda s, i: s + F.get(w, i)) / scale) / model.temperature)
            return _let(scores, lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))

        def verdict(p: Column) -> Column:
            probability = F.array_max(p) / F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
            return F.struct(probability.alias("probability"), (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("at"))

        return _let(_let(hashed, probabilities), verdict)

    def shares(own: Column, at: Column) -> Column:
        enough = F.size(F.array_intersect(own, F.get(known, at))) >= SHARED * F.size(own)
        return enough | F.exists(F.get(every, at), lambda t: F.size(F.array_intersect(t, own)) >= SHARED * F.size(t))

    def whole(words: Column) -> Column:
        def best(judged: Column) -> Column:
            def confirmed(own: Column) -> Column:
                return F.array_max(
                    F.transform(
                        judged,
                        lambda j: F.struct(
                            ((j["at"] > 0) & (j["probability"] >= LEAST) & shares(own, j["at"])).alias("confirmed"),
                            j["probability"].alias("probability"),
                            F.get(names, j["at"]).alias("family"),
                        ),
                    )
                )

            triples = F.when(F.size(words) < 3, F.array(F.array_join(words, " "))).otherwise(F.array_distinct(_grams(words, 3)))
            likely = F.exists(judged, lambda j: (j["at"] > 0) & (j["probability"] >= LEAST))
            # no triples are made of paragraphs that have nothing to confirm
            return _let(F.when(likely, triples).otherwise(F.array(F.lit(""))), confirmed)

        # a paragraph that only mentions licences has no window to judge
        unknown = F.struct(F.lit(False).alias("confirmed"), F.lit(None).cast("double").alias("probability"), F.lit("unknown").alias("family"))
        return F.coalesce(_let(F.transform(F.filter(_windows(words), _cued), judge), best), unknown)

    words = F.array_remove(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), "")
    return _let(words, lambda w: F.when(_cued(w) | F.rlike(paragraph, F.lit(MENTION)), whole(w)))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, family, its probability, and the numbers of scored and confirmed paragraphs.

    ``family`` is that of the confirmed paragraph of highest probability.
    """
    model = trained()
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    paragraphs = F.transform(F.split(text, r"\n\s*\n", -1), lambda paragraph: _scored(paragraph, model))
    scored = docs.select(F.col(id_column).alias("doc_id"), F.filter(paragraphs, lambda s: s.isNotNull()).alias("scored"))
    sure = scored.withColumn("best", F.array_max(F.filter("scored", lambda s: s["confirmed"])))
    family = F.coalesce("best.family", F.when(F.size("scored") > 0, "unknown").otherwise("none"))
    return sure.select(
        "doc_id",
        family.alias("family"),
        F.col("best.probability").alias("probability"),
        F.size("scored").cast("long").alias("n_scored"),
        F.size(F.filter("scored", lambda s: s["confirmed"])).cast("long").alias("n_confirmed"),
    )
