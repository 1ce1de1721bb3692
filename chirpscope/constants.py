"""Fixed values.

These values must stay exactly as they are for results to agree with the
behaviour this library re-implements (patterns, thresholds, labels, colours,
keywords, prompt texts).  They are stated plainly and together on purpose.
"""

# --- fixed values: extraction patterns -------------------------------------
MENTION_PATTERN = r"@([A-Za-z0-9_]{1,15})"
HASHTAG_PATTERN = r"#([A-Za-z0-9_]+)"

# --- fixed values: node-key prefixes and node types ------------------------
USER_ID_PREFIX = "user:"
UNKNOWN_AUTHOR = "None"             # posts without an author share one node
HANDLE_PREFIX = "@"
TAG_PREFIX = "#"
NODE_TYPE_USER = "user"
NODE_TYPE_USER_ID = "user_id"
NODE_TYPE_HASHTAG = "hashtag"
NODE_TYPE_OTHER = "other"
GRAPH_KIND_MENTION = "mention"
GRAPH_KIND_HASHTAG = "hashtag"

# --- fixed values: polarity classes -----------------------------------------
POSITIVE = "positive"
NEGATIVE = "negative"
NEUTRAL = "neutral"
POLARITY_THRESHOLD = 0.05          # > +t positive, < -t negative, else neutral
MODEL_ERROR_LABEL = "ERROR"
MODEL_MAX_CHARS = 512              # text prefix handed to a sentiment model

# --- fixed values: graph algorithms ------------------------------------------
PAGERANK_ALPHA = 0.85
PAGERANK_MAX_ITER = 100
PAGERANK_TOL = 1.0e-6
TOP_K = 10

# --- fixed values: display layers (two-layer network tables) -----------------
MENTION_NODE_COLOR = "#3b82f6"
MENTION_EDGE_COLOR = "#60a5fa"
HASHTAG_NODE_COLOR = "#10b981"
HASHTAG_EDGE_COLOR = "#34d399"

# --- fixed values: summarisation ----------------------------------------------
NEWEST_K = 200
CHUNK_SIZE = 15
SUMMARY_KEYWORDS = ["gold", "silver", "xau", "xag", "precious"]
CHUNK_INSTRUCTION = (
    "Summarize the following tweets in 3–4 sentences. "
    "Focus on overall sentiment and key discussion themes. "
    "Ignore duplicates, links, and hashtags.\n\n"
)
FINAL_INSTRUCTION = (
    "Summarize the following chunk summaries into one cohesive analytical market wrap. "
    "Include macro themes like Fed policy, interest rates, inflation tone, crypto sentiment, "
    "and gold/silver movements. Keep it concise (4–6 sentences), professional, and neutral.\n\n"
    "Chunk summaries:\n"
)
FINAL_SUFFIX = "\n\nFinal Summary:"

# --- fixed values: search --------------------------------------------------
DEFAULT_SEARCH = "fed rate cut lang:en -is:retweet"
