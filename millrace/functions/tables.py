"""Table functions for SQL: many rows from one, or from the ordered rows of a group.

``register`` gives them to a session:

    SELECT d.doc_id, b.* FROM docs d, LATERAL code_blocks(d.text) b
    SELECT * FROM turn_pairs(TABLE(SELECT conv_id, role, text, turn FROM conversations) PARTITION BY conv_id ORDER BY turn)
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.functions.extract import NAMED_FENCE

# The same pattern as of the column functions: there, U makes \\w match letters of all scripts, which it does here in any case.
FENCE = re.compile(NAMED_FENCE.replace("(?sdU)", "(?s)"))


@F.udtf(returnType="place int, lang string, code string", useArrow=True)
class CodeBlocks:
    """The fenced blocks of a text, numbered from 1; a block without a tag is Python. Null and blockless texts have none."""

    def eval(self, text: str):
        for i, m in enumerate(FENCE.finditer(text or ""), 1):
            yield i, m.group(1).lower() or "python", m.group(2)


@F.udtf(returnType="conv_id long, place int, prompt string, response string", useArrow=True)
class TurnPairs:
    """Of a conversation's rows in order, each user turn that an assistant turn follows, numbered from 1.

    Reads columns conv_id, role and text. Other roles, and user turns without an answer, part nothing and are passed over; null
    texts are empty. Only the last user turn is held, so a conversation of any length streams through.
    """

    def __init__(self):
        self.place, self.asked = 0, None

    def eval(self, row):
        role, text = row["role"], row["text"] or ""
        if role == "user":
            self.asked = text
        elif role == "assistant" and self.asked is not None:
            self.place += 1
            yield row["conv_id"], self.place, self.asked, text
            self.asked = None


def register(spark: SparkSession) -> None:
    """Make ``code_blocks`` and ``turn_pairs`` known to the session's SQL."""
    spark.udtf.register("code_blocks", CodeBlocks)
    spark.udtf.register("turn_pairs", TurnPairs)
