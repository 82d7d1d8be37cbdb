"""Prompt texts, chat rendering and answer parsing as native columns."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Prompt texts, label words, defaults and the answer pattern.
# They must be equal to the trained and evaluated prompts, character by
# character, including the blank after "###C### ".
# ---------------------------------------------------------------------------
JUDGMENT_PROMPT = """You are a legal-analysis assistant. You will be given a Swiss Federal Supreme Court case along with its metadata and the full text of the opinion. Your task is to classify the outcome of the case.

TASK:
Return exactly one label: either "approval" or "dismissal". Output only one of these two words, with no additional text.

INSTRUCTIONS:
1. Carefully read the metadata below.
2. Carefully read the full case text.
3. Determine whether the correct outcome is "approval" or "dismissal".
4. Your final answer must be exactly one of these two labels:
   - approval
   - dismissal
5. Do not output anything else: no explanations, no justification, no punctuation, no commentary.

--- METADATA ---
Year: {year}
Language: {language}
Source language: {source_language}
Region: {region}
Canton: {canton}
Legal area: {legal_area}

Below is the complete case text.

<BEGIN CASE TEXT>
{text}
<END CASE TEXT>"""

MCQ_PROMPT = """You are an expert in {course_name} and address legal issues in a structured, exam-style manner.
You are given a multiple-choice question, where only one choice (e.g., A, B, C, etc.) is correct.
Assume Swiss law applies unless specifically stated otherwise. If the context of the course justifies it, consider legal frameworks beyond Swiss law as well.

Please reason through the question step by step, using a chain-of-thought approach:
- Clarify the facts: Briefly restate or highlight the key facts in the question to anchor your reasoning.
- Issue Identification: What legal issue(s) arise from the facts?
- Rule Explanation: What legal rules or principles are relevant, and what are their sources (e.g., statutes, case law, doctrine)?
- Application and Reasoning: Apply the relevant rules to the facts, carefully weighing any ambiguities, exceptions, or competing interpretations.
- Eliminate Incorrect Answers: Briefly explain why each incorrect answer is wrong or less convincing.
- Conclusion: Clearly state the correct answer choice (e.g., A, B, C, etc.) with a brief justification for why it best fits the legal analysis.

Format your final answer as follows:
 Correct Answer: ###C### 

Question:
 {question}

Answer:"""

METADATA_FIELDS = ("year", "language", "source_language", "region", "canton", "legal_area")
MISSING_METADATA = "N/A"
DEFAULT_COURSE = "Law"
LABEL_WORDS = {0: "dismissal", 1: "approval"}
DISMISSAL_WORDS = ("dismissal", "dismissed")
APPROVAL_WORDS = ("approval", "approved")
UNPARSED_LABEL = -1
UNPARSED_CHOICE = "None"
CHOICE_PATTERN = "###([A-Z]+)###"
# ---------------------------------------------------------------------------


def fill_template(template: str, **values: Column) -> Column:
    """Substitute each ``{field}`` once.

    The result is one ``concat`` of literals and columns, so braces inside a
    value are never read as fields again.
    """
    parts: list[Column] = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field is not None:
            parts.append(values[field])
    return F.concat(*parts)


def shown(value: Column, dtype: T.DataType | None = None) -> Column:
    """A value the way a text template shows it: a null is the word ``None``."""
    text = value.cast("string")
    if isinstance(dtype, T.BooleanType):
        text = F.initcap(text)
    return F.coalesce(text, F.lit("None"))


def shown_field(df: DataFrame, name: str, absent: str) -> Column:
    """``shown`` for a field; a *missing column* shows ``absent`` instead."""
    if name not in df.columns:
        return F.lit(absent)
    return shown(F.col(f"`{name}`"), df.schema[name].dataType)


def judgment_prompt(df: DataFrame, text_col: str = "text") -> Column:
    """The judgment prompt of each row; the same text for training and inference."""
    fields = {name: shown_field(df, name, MISSING_METADATA) for name in METADATA_FIELDS}
    return fill_template(JUDGMENT_PROMPT, text=shown_field(df, text_col, ""), **fields)


def label_word(df: DataFrame, name: str = "label") -> Column:
    """Class number to answer word; any other value keeps its own text."""
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    value = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return shown(value, dtype)
    number = value.cast("int") if isinstance(dtype, T.BooleanType) else value
    out = F.when(number == 0, LABEL_WORDS[0]).when(number == 1, LABEL_WORDS[1])
    return out.otherwise(shown(value, dtype))


def answer_label(text: Column) -> Column:
    """Class named in a generated answer: 0, 1, or -1 when none is named.

    A dismissal word anywhere wins over an approval word.
    """
    lowered = F.lower(text)

    def names_one(words: tuple[str, ...]) -> Column:
        return reduce(or_, [lowered.contains(word) for word in words])

    return F.when(names_one(DISMISSAL_WORDS), 0).when(names_one(APPROVAL_WORDS), 1).otherwise(UNPARSED_LABEL)


def answer_label_of(df: DataFrame, name: str) -> Column:
    """``answer_label`` of a column; a missing or non-text column is unparsable."""
    if name in df.columns and isinstance(df.schema[name].dataType, T.StringType):
        return answer_label(F.col(f"`{name}`"))
    return F.lit(UNPARSED_LABEL)


def choice_label(index: Column) -> Column:
    """0, 1, ... to A ... Z, AA, AB, ...; null below 0.

    The label has a letter at place ``p`` (from the right) once the index
    reaches the number of labels with at most ``p`` letters.  Seven places
    cover every INT.
    """
    wide = index.cast("long")
    letters: list[Column] = []
    first = 0
    for place in range(7):
        digit = F.floor((wide - first) / F.lit(26**place)) % 26
        letter = F.chr(F.lit(65) + digit.cast("long"))
        letters.append(letter if place == 0 else F.when(wide >= first, letter).otherwise(""))
        first += 26 ** (place + 1)
    return F.when(wide >= 0, F.concat(*reversed(letters)))


def gold_label(gold: Column, n_choices: Column) -> Column:
    """Letter of the right choice; an index outside the choices gives null.

    A negative index counts from the last choice, as list indexing does.
    """
    at = F.when(gold < 0, gold + n_choices).otherwise(gold)
    return F.when(at < n_choices, choice_label(at))


def choice_lines(choices: Column) -> Column:
    """One ``\\n{label}. {choice}`` line per choice; empty without choices."""
    lines = F.transform(choices, lambda c, i: F.concat(F.lit("\n"), choice_label(i), F.lit(". "), shown(c)))
    return F.coalesce(F.array_join(lines, ""), F.lit(""))


def mcq_prompt(df: DataFrame, choices: Column, question_col: str = "question") -> Column:
    """The multiple-choice prompt of each row."""
    question = F.concat(F.col(f"`{question_col}`"), choice_lines(choices))
    return fill_template(MCQ_PROMPT, course_name=shown_field(df, "course", DEFAULT_COURSE), question=question)


def check_choice_pattern(pattern: str) -> int:
    """The group to extract; a pattern with several groups has no single answer."""
    groups = re.compile(pattern).groups
    if groups > 1:
        raise ValueError(f"the answer pattern may have one group, not {groups}: {pattern}")
    return groups


def parse_choice(text: Column, pattern: str = CHOICE_PATTERN) -> Column:
    """The last match of the answer pattern, else the word ``None``."""
    group = check_choice_pattern(pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(UNPARSED_CHOICE))


@dataclass(frozen=True)
class ChatFormat:
    """Delimiters of one turn.  A model's own format is passed in here."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_turn: str = "<|im_end|>\n"

    def reply_start(self) -> str:
        return f"{self.before_role}assistant{self.after_role}"


def render_chat(messages: Column, fmt: ChatFormat = ChatFormat(), add_generation_prompt: bool = False) -> Column:
    """A message list as one string, optionally opened for the reply."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(fmt.before_role), shown(m["role"]), F.lit(fmt.after_role), shown(m["content"]), F.lit(fmt.after_turn)
        ),
    )
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(fmt.reply_start())) if add_generation_prompt else text


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def token_count(text: Column) -> Column:
    """Number of runs of non-blank characters."""
    return F.regexp_count(text, F.lit("[^ \\t\\n\\r\\f]+"))
