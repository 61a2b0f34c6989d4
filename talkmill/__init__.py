"""talkmill: transcript curation and memory-store auditing as Spark DataFrame operators."""
