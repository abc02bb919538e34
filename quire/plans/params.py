"""Parameters of the catalogue queries over the shared tables."""

# Vocabulary of the article queries, in tie-break order; the
# last term occurs in no document on purpose.
ARTICLE_VOCAB = ["the", "of", "and", "to", "a", "in", "is", "that",
                 "der", "die", "und", "la", "que", "le", "zzqx"]
MENTION_TERM = "the"
INDEX_BLOCK_SIZE = 200

# Vocabulary of the posting queries (order priorities as tags;
# "4-NOT SPECIFIED" stays outside on purpose).
POSTING_VOCAB = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
SPREAD = 50_000
MIXED_SPREAD = 100
KERNELS = 12
ETA = 20.0
MAX_ITERATIONS = 120
SEED = 42

# The posting program's own size: 45 centres, here nine for each of five tags.
ALL_TAGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ALL_KERNELS = 45

# Answers in a block of `grouped_posting_blocks`.
ANSWER_BLOCK_SIZE = 2

# The posting program's vocabulary size: 15 tags (priority and status of an
# order), three centres each.
PAIR_TAGS = [f"{p}/{s}" for p in ALL_TAGS for s in ("F", "O", "P")]
PAIR_KERNELS = 45

# More centres than the plan has distances for, over all tags.
MANY_KERNELS = 200

# Postings in a block of the stored index.
STORED_BLOCK_SIZE = 64
STORED_TERMS = ["the", "der", "zzqx"]

# Buckets of the stored postings.
BUCKETS = 8
