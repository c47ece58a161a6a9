"""Language of a text by cross-parsing entropy.

For each language, a suffix automaton of labelled text knows every string that occurs in
it. A text is parsed from left to right into phrases, each the longest that occurs in the
language's text: the fewer phrases, the closer the language. A phrase costs as many bits
as it takes to name a place in the language's text, so that languages with more text have
no advantage; the language with the fewest bits wins.

Automata are fitted on a bounded sample of labelled rows: ``SAMPLE_ROWS`` different texts
of each language, ``SAMPLE_CHARS`` characters of each. They are built by one task per
language and reach the workers in rounds of ``ROUND_LANGUAGES``; each round carries the
best two languages of every text on to the next. Texts are never shuffled.
"""

from __future__ import annotations

import gc
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.frames import staged

#: Bounds of the sample that a language is learned from.
SAMPLE_ROWS = 64
SAMPLE_CHARS = 2000
#: Languages whose automata a worker holds at once; each has under 2 * rows * chars states.
ROUND_LANGUAGES = 32
UNDECIDED = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Stands for the border between two texts; no text contains it once prepared.
BORDER = "\n"

AUTOMATA = "lang string, length long, states long, sources binary, letters string, targets binary"
CARRIED = "best_lang string, best_bits double, next_bits double"


def prepared(text: str) -> str:
    """Letters in lower case; whatever is between them becomes one space."""
    return NOT_LETTERS.sub(" ", text.lower())


class SuffixAutomaton:
    """Transitions of the smallest automaton of all suffixes of a text, state 0 its start."""

    def __init__(self, text: str):
        self.moves: list[dict[str, int]] = [{}]
        self._longest, self._link = [0], [-1]
        last = 0
        for letter in text:
            last = self._extend(last, letter)

    def _extend(self, last: int, letter: str) -> int:
        moves, longest, link = self.moves, self._longest, self._link
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and letter not in moves[at]:
            moves[at][letter] = new
            at = link[at]
        if at >= 0:
            reached = moves[at][letter]
            if longest[reached] == longest[at] + 1:
                link[new] = reached
            else:
                copy = len(moves)
                moves.append(dict(moves[reached]))
                longest.append(longest[at] + 1)
                link.append(link[reached])
                while at >= 0 and moves[at].get(letter) == reached:
                    moves[at][letter] = copy
                    at = link[at]
                link[reached] = link[new] = copy
        return new


def linked_states(states: int, sources: np.ndarray, letters: str, targets: np.ndarray) -> dict:
    """The start state, states being dicts from a letter to the next state."""
    nodes: list[dict] = [{} for _ in range(states)]
    for source, letter, target in zip(sources.tolist(), letters, targets.tolist()):
        nodes[source][letter] = nodes[target]
    return nodes[0]


def count_phrases(text: str, start: dict) -> int:
    """Phrases of the parse; a letter the language does not have is one by itself."""
    nowhere: dict = {}
    restart = start.get
    phrases, state = 0, nowhere
    for letter in text:
        state = state.get(letter)
        if state is None:
            phrases += 1
            state = restart(letter, nowhere)
    return phrases


class _Languages:
    """Languages of a round; a worker links their states once, whatever tasks it runs."""

    def __init__(self, rows: list):
        self.rows = rows
        self._linked: list[tuple[str, float, dict]] | None = None

    def linked(self) -> list[tuple[str, float, dict]]:
        """(name, bits of a phrase, start state)."""
        if self._linked is None:
            gc.disable()  # hundreds of thousands of small dicts that all stay
            self._linked = []
            for lang, length, states, sources, letters, targets in self.rows:
                edges = (np.frombuffer(sources, "<i4"), letters, np.frombuffer(targets, "<i4"))
                self._linked.append((lang, math.log2(max(length, 2)), linked_states(states, *edges)))
            gc.freeze()
            gc.enable()
        return self._linked


def _automaton(group: pd.DataFrame) -> pd.DataFrame:
    """Automaton of one language's sample, which is bounded."""
    texts = [prepared(text) for text in group.sort_values("turn")["snippet"]]
    joined = BORDER.join(texts)
    moves = SuffixAutomaton(joined).moves
    edges = [(n, letter, to) for n, out in enumerate(moves) for letter, to in sorted(out.items()) if letter != BORDER]
    sources, letters, targets = zip(*edges) if edges else ((), (), ())
    return pd.DataFrame(
        {
            "lang": [group["lang"].iloc[0]],
            "length": [len(joined)],
            "states": [len(moves)],
            "sources": [np.array(sources, "<i4").tobytes()],
            "letters": ["".join(letters)],
            "targets": [np.array(targets, "<i4").tobytes()],
        }
    )


def learn_languages(
    rows: DataFrame, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """One suffix automaton per language, from a bounded sample of the rows.

    Rows without text, letters or language teach nothing. Which rows are taken follows from
    their texts alone: equal texts count once, so groups of copies do not fill the sample,
    and of a long text a stretch is taken whose place follows from the text.
    """
    text = F.col("text")
    key = F.xxhash64("text")
    room = F.greatest(F.char_length(text) - F.lit(SAMPLE_CHARS), F.lit(0)) + 1
    taught = rows.select(
        F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & text.rlike(r"\p{L}"))
    taught = taught.select("lang", key.alias("key"), text.substr(F.pmod(key, room).cast("int") + 1, F.lit(SAMPLE_CHARS)).alias("snippet"))
    # A narrow aggregate first: the share of different texts that is needed, four times over.
    sizes = taught.groupBy("lang").agg(F.approx_count_distinct("key").alias("different"))
    share = F.least(F.lit(1.0), F.lit(4.0 * SAMPLE_ROWS) / F.col("different"))
    limits = staged(sizes.select("lang", (share * F.lit(float(1 << 30))).alias("limit")), "language-shares")
    drawn = taught.join(limits, "lang").where(F.pmod("key", F.lit(1 << 30)) < F.col("limit"))
    once = drawn.groupBy("lang", "key").agg(F.min("snippet").alias("snippet"))
    order = Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 30)), "key")
    sample = once.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SAMPLE_ROWS)
    return staged(
        sample.select("lang", "turn", "snippet").groupBy("lang").applyInPandas(_automaton, AUTOMATA),
        "languages",
    )


def _parse_round(texts: DataFrame, automata: list) -> DataFrame:
    """Texts with the best of these languages and of the rounds before, by bits."""
    shared = texts.sparkSession.sparkContext.broadcast(_Languages([tuple(row) for row in automata]))
    names = texts.columns

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = shared.value.linked()
        for batch in batches:
            kept = {name: batch.column(name) for name in names}
            found = []
            for text, lang, best, second in zip(
                kept["text"], *(kept[part.split()[0]].to_pylist() for part in CARRIED.split(", "))
            ):
                letters = prepared(text.as_py())
                for name, bits, start in languages:
                    cost = bits * count_phrases(letters, start)
                    if best is None or (cost, name) < (best, lang):
                        lang, best, second = name, cost, best
                    elif second is None or cost < second:
                        second = cost
                found.append((lang, best, second))
            columns = list(zip(*found)) or [(), (), ()]
            kinds = [pa.string(), pa.float64(), pa.float64()]
            carried = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            rest = names[: -len(carried)]
            yield pa.RecordBatch.from_arrays([kept[name] for name in rest] + carried, names)

    return texts.mapInArrow(parse, texts.schema)


def predict_languages(
    docs: DataFrame,
    automata: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """doc_id, lang_pred, score and the columns of ``carry``, one row per input row.

    ``score`` is how much cheaper the best language is than the second, as a share of the
    second's bits: 0 for a tie (the first name wins), 1 if only one language is known. A
    text that is null or has no letter is ``und`` with score 0, as is every text if no
    language was learned. Texts are parsed whole. Null and repeated ids are carried along.
    """
    carry = carry or {}
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text.alias("text"),
        *(column.alias(name) for name, column in carry.items()),
        F.lit(None).cast("string").alias("best_lang"),
        F.lit(None).cast("double").alias("best_bits"),
        F.lit(None).cast("double").alias("next_bits"),
    )
    names = [row.lang for row in automata.select("lang").orderBy("lang").collect()]
    for at in range(0, len(names), ROUND_LANGUAGES):
        held = automata.where(F.col("lang").isin(names[at : at + ROUND_LANGUAGES])).orderBy("lang")
        texts = _parse_round(texts, held.collect())
    decided = F.col("text").rlike(r"\p{L}") & F.col("best_lang").isNotNull()
    margin = F.when(F.col("next_bits").isNull(), 1.0).otherwise(1 - F.col("best_bits") / F.col("next_bits"))
    return texts.select(
        "doc_id",
        *carry,
        F.when(decided, F.col("best_lang")).otherwise(UNDECIDED).alias("lang_pred"),
        F.when(decided, margin).otherwise(0.0).alias("score"),
    )
