"""They must equal the published ones for results to agree. All are defaults of parameters."""

# Words left out of the word rankings.
STOP_WORDS = (
    "the", "and", "for", "you", "that", "this", "with", "are", "was", "but", "not", "have", "from", "they", "his",
    "her", "she", "him", "your", "what", "when", "where", "who", "why", "how", "can", "will", "just", "about",
    "like", "get", "all", "out", "one", "its", "it's", "i", "a", "an", "to", "of", "in", "on", "is", "it", "as",
    "at", "be", "or", "by", "we", "he", "me", "my", "so", "if", "do", "no", "yes", "has", "more", "even", "there",
    "their", "would", "should", "them", "don", "does", "did", "also", "got", "make", "made", "much", "many",
    "still", "really", "very",
)

# The fields of study that make up the social-science scope.
SOCIAL_FIELDS = (
    "Social network",
    "Social media",
    "Social network analysis",
    "Sentiment analysis",
    "Recommender system",
    "Viral marketing",
    "Social Semantic Web",
    "Social psychology",
)

# Class names in index order, year scope, seeds.
SENTIMENTS = ("Negative", "Neutral", "Positive")
MIN_YEAR = 2010
MAX_YEAR = 2020
TREND_MAX_YEAR = 2018
SAMPLE_SEED = 42
TREE_SEED = 67
UNKNOWN_VENUE = "unknown_venue"

# String fields of a stream message, in order.
MESSAGE_FIELDS = ("comment_id", "video_id", "text", "author", "published_at", "fetched_at", "source")
