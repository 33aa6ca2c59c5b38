"""Word lists used by the text operators. All are parameters of the operators; these are defaults."""

# --- fixed values: label stop list of the community labeller (T6), in the reference's order -----------
LABEL_STOP_WORDS = ['english', 'https', 'http', 'rt', 'co', 'is', 'the', 'and',
                    'of', 'to', 'in', 'a', 'for', 'that', 'it', 'this', 'with',
                    'on', 'as', 'at', 'by', 'an', 'be', 'are', 'was', 'were', 'from',
                    'will', 'they', 'he', 'she', 'you', 'we', 'they', 'my', 'your']

# Default English stop list for TF-IDF (self-written, common function words). The reference used a
# library's built-in list; pass that list as ``stop_words`` for exact parity.
TFIDF_STOP_WORDS = sorted(set("""
a about above after again against all am an and any are as at be because been before being below between
both but by can could did do does doing down during each few for from further had has have having he her
here hers herself him himself his how i if in into is it its itself just me more most my myself no nor not
now of off on once only or other our ours ourselves out over own same she should so some such than that the
their theirs them themselves then there these they this those through to too under until up very was we were
what when where which while who whom why will with would you your yours yourself yourselves also us may might
must shall upon yet via per among within without however thus therefore""".split()))

# Sentiment lexicon (self-written valences on a -4..4 scale), negations and intensity modifiers.
SENTIMENT_LEXICON = {
    "good": 1.9, "great": 3.1, "excellent": 3.2, "amazing": 2.8, "awesome": 3.1, "best": 3.2, "better": 1.9,
    "love": 3.2, "like": 1.5, "happy": 2.7, "nice": 1.8, "win": 2.8, "winning": 2.4, "success": 2.7,
    "strong": 2.3, "positive": 2.6, "gain": 2.0, "gains": 2.0, "profit": 1.9, "growth": 1.6, "up": 0.5,
    "wow": 2.8, "cool": 1.3, "fun": 2.3, "beautiful": 2.9, "brilliant": 2.8, "incredible": 2.6, "true": 1.2,
    "agree": 1.5, "thanks": 1.9, "thank": 1.5, "exciting": 2.2, "perfect": 2.7, "fantastic": 2.6,
    "bad": -2.5, "worst": -3.1, "worse": -2.1, "terrible": -2.5, "awful": -2.0, "hate": -2.7, "sad": -2.1,
    "poor": -2.1, "lose": -1.7, "loss": -1.3, "losing": -1.6, "fail": -2.5, "failure": -2.3, "wrong": -2.1,
    "weak": -1.9, "negative": -2.3, "crash": -1.7, "drop": -1.1, "down": -0.6, "fear": -2.2, "angry": -2.3,
    "problem": -1.7, "risk": -1.1, "scam": -2.6, "fraud": -2.8, "fake": -2.1, "crisis": -3.1, "kill": -3.7,
    "dead": -3.3, "broken": -1.8, "stupid": -2.4, "boring": -1.3, "ugly": -2.3, "never": -0.4,
}
NEGATIONS = ["not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "cannot",
             "without", "don't", "doesn't", "didn't", "isn't", "aren't", "wasn't", "weren't", "won't",
             "wouldn't", "can't", "couldn't", "shouldn't", "hasn't", "haven't", "hadn't", "ain't"]
BOOSTERS_UP = ["very", "really", "extremely", "so", "totally", "absolutely", "incredibly", "highly",
               "completely", "especially", "most", "more", "super", "truly"]
BOOSTERS_DOWN = ["slightly", "somewhat", "barely", "hardly", "less", "little", "marginally", "partly"]
# Published VADER constants: booster increment, negation scalar, normalisation alpha.
BOOST = 0.293
NEGATION_SCALAR = -0.74
ALPHA = 15.0
