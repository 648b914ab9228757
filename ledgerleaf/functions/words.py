"""Small author-written word tables. All are fixed values."""

STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "also", "am", "an", "and", "any", "are", "as", "at",
    "be", "because", "been", "before", "being", "below", "between", "both", "but", "by",
    "can", "could", "did", "do", "does", "doing", "down", "during", "each", "few", "for", "from", "further",
    "had", "has", "have", "having", "he", "her", "here", "hers", "him", "his", "how",
    "i", "if", "in", "into", "is", "it", "its", "just", "me", "more", "most", "must", "my",
    "no", "nor", "not", "now", "of", "off", "on", "once", "only", "or", "other", "our", "ours", "out", "over", "own",
    "same", "she", "should", "so", "some", "such", "than", "that", "the", "their", "them", "then", "there", "these",
    "they", "this", "those", "through", "to", "too", "under", "until", "up", "upon", "us",
    "very", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom", "why", "will", "with",
    "would", "you", "your", "yours",
]

POSITIVE_WORDS = [
    "amazing", "best", "better", "clear", "easy", "excellent", "fair", "fast", "fine", "friendly", "good", "great",
    "happy", "helpful", "honest", "improve", "kind", "like", "love", "nice", "perfect", "pleasant", "reliable",
    "safe", "smart", "strong", "success", "thank", "useful", "win",
]

NEGATIVE_WORDS = [
    "angry", "awful", "bad", "broken", "clown", "difficult", "error", "fail", "failure", "garbage", "hate", "horrible",
    "idiot", "issue", "late", "loser", "moron", "pathetic", "poor", "problem", "sad", "scum", "slow", "stupid",
    "terrible", "trash", "ugly", "unfair", "wrong", "worst",
]

# English to French, the direction of the default translation task.
GLOSSARY = {
    "the": "le", "of": "de", "and": "et", "to": "vers", "in": "dans", "a": "un", "is": "est", "that": "cela",
    "it": "il", "for": "pour", "was": "était", "on": "sur", "with": "avec", "be": "être", "as": "comme", "by": "par",
    "this": "ceci", "are": "sont", "at": "chez", "from": "depuis", "or": "ou", "not": "pas", "here": "ici",
    "best": "meilleur", "license": "licence", "rights": "droits",
}

# Nouns whose singular no suffix rule gives.
LEMMA_EXCEPTIONS = {
    "children": "child", "feet": "foot", "geese": "goose", "mice": "mouse", "people": "people", "teeth": "tooth",
    "data": "data", "series": "series", "news": "news", "this": "this", "his": "his", "was": "was", "has": "has",
}

# Abbreviations whose full stop does not end a sentence.
ABBREVIATIONS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Inc", "Ltd", "vs", "No", "St"]

MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
