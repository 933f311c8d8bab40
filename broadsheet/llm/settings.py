"""Parameters of the named queries and the pipeline."""

from broadsheet.llm.mixing import Mix

# a key for the checks; real runs pass their own
PSEUDONYM_KEY = "key of the checks"

# a language mix, sources and topics evened out
MIX = Mix(
    targets={"lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}},
    temperatures={"source": 0.5, "topic": 0.7},
)
