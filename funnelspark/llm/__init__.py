"""Training-data operators (quality, secrets, tokenizing, extraction, dedup,
decontamination, search, toxicity) and their queries.  Nothing else in the
library imports this subpackage."""
