"""Training-data operators: near and substring dedup, mixing, personal data,
secrets, decontamination, quality models and rules, sharding, corpus scoring."""
