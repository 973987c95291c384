"""Default word lists and patterns. Operators take others as parameters."""

# Results depend on these exact words and patterns.

TITLES = ["Mr", "Mrs", "Miss", "Ms", "Dr", "Sir", "Captain", "Professor", "Lord", "Lady", "King", "Queen", "Prince", "Princess"]

PERSON_TITLES = [
    "mr", "mrs", "ms", "miss", "dr", "prof", "professor", "capt", "captain", "sir", "lady", "lord", "rev", "reverend",
    "colonel", "major", "lieutenant", "herr", "monsieur", "madame",
]

HONORIFICS = ["mr", "mrs", "miss", "ms", "dr", "sir", "captain", "professor", "lord", "lady", "king", "queen", "prince", "princess"]

SPEECH_VERBS = ["said", "replied", "asked", "cried", "shouted", "exclaimed", "answered", "whispered", "remarked", "observed"]

PLACE_CUES = ["in", "at", "from", "to", "near", "on", "into", "across", "through", "upon", "toward", "towards", "beside", "around"]

SETTINGS = [
    "river", "mountain", "mountains", "village", "town", "city", "sea", "ocean", "forest", "cave", "cavern", "island", "islands",
    "desert", "road", "roadway", "station", "tunnel", "mine", "gallery", "shaft", "shore", "bank", "banks", "camp", "room", "house",
    "valley", "lake", "hill", "hills", "coast", "plain", "plains", "stream",
]

NAME_STOP = [
    "The", "This", "That", "These", "Those", "And", "But", "Then", "When", "Where", "What", "Which", "There", "Their", "They",
    "He", "She", "His", "Her", "It", "I", "We", "You", "Our", "Chapter", "Scene", "Page", "Monday", "Tuesday", "Wednesday",
    "Thursday", "Friday", "Saturday", "Sunday", "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December", "entered", "enter", "went", "go", "came", "come", "left", "leave", "crossed",
    "cross", "reached", "reach", "saw", "see", "looked", "look", "found", "find", "passed", "pass", "walked", "walk", "rode",
    "ride", "stood", "stand", "sat", "set", "put", "took", "take", "made", "make", "began", "begin",
]

PROPS = [
    "map", "compass", "lantern", "lamp", "rope", "pickaxe", "axe", "hammer", "rifle", "gun", "pistol", "knife", "dagger", "sword",
    "bag", "backpack", "satchel", "bottle", "flask", "book", "journal", "diary", "letter", "parchment", "instrument",
    "thermometer", "barometer", "telescope", "microscope", "boat", "raft", "carriage", "wagon", "vehicle", "machine", "key",
    "door", "bridge",
]

COMMON_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "been", "before", "but", "by", "can", "could", "did", "do", "does", "for", "from", "had", "has", "have",
    "he", "her", "here", "him", "his", "how", "i", "if", "in", "is", "it", "its", "just", "like", "many", "more", "most", "my", "never", "no", "not",
    "now", "of", "on", "one", "or", "only", "perhaps", "quite", "rather", "said", "see", "she", "so", "some", "such", "than", "that", "the", "their",
    "them", "then", "there", "these", "they", "this", "those", "through", "to", "too", "two", "under", "up", "us", "very", "was", "we", "were", "what",
    "when", "where", "which", "while", "why", "who", "will", "with", "without", "would", "you", "your", "after", "above", "about", "again", "almost",
    "already", "also", "always", "another", "any", "anyone", "anything", "around", "because", "behind", "below", "between", "both", "during", "each",
    "either", "enough", "every", "everywhere", "except", "few", "first", "following", "further", "get", "got", "great", "half", "however", "indeed",
    "instead", "itself", "last", "less", "little", "long", "maybe", "most", "much", "neither", "next", "none", "nothing", "often", "once", "other",
    "otherwise", "over", "same", "several", "since", "someone", "something", "soon", "still", "though", "three", "together", "toward", "towards",
    "until", "upon", "well", "whatever", "whenever", "whether", "within", "yet", "having", "ice", "all", "besides", "certainly", "come", "doubtless",
    "hence",
]

#: Words that are no name by themselves, titles included.
NON_NAMES = [
    "after", "all", "and", "are", "before", "but", "for", "from", "how", "let", "not", "nothing", "now", "one", "some", "still", "suddenly", "that", "the",
    "then", "this", "while", "with", "yes", "no", "we", "they", "he", "she", "sir", "colonel", "professor", "captain", "mr", "dr", "lady", "lord",
]

#: Names of places that pass for names of people.
PLACE_NAMES = ["africa", "iceland", "england", "russia", "europe", "europeans", "london", "cape town", "south africa", "greenwich", "zambesi", "kalahari"]

DEMOGRAPHIC_WORDS = [
    "african", "english", "englishman", "european", "french", "icelandic", "icelanders", "russians", "danish", "makololos", "makololo",
    "bochjesmen", "queen", "earth", "orange", "reykjawik", "sneffels", "mother",
]

ROLE_WORDS = [
    "river", "rivers", "mount", "mountain", "mountains", "lake", "ocean", "sea", "island", "islands", "colony", "republic", "government",
    "commission", "observatory", "institution", "post", "world", "africa", "hope", "zambesi", "cape", "port", "town", "city", "village",
    "forest", "valley", "country", "countrymen", "empire", "kingdom", "company", "society", "school", "university", "museum", "academy",
    "station", "road", "roads", "falls", "fall", "gulfs", "gulf", "desert", "coast", "shore", "bay", "peninsula", "expedition", "party",
    "tribe", "people", "new", "zealand", "atlantic", "balearic", "central", "subterranean",
]

SEMANTIC_BLOCK_WORDS = [
    "river", "ocean", "sea", "lake", "mount", "mountain", "cape", "island", "africa", "colony", "government", "commission",
    "observatory", "institution", "post", "advertiser", "journal", "gazette", "railway", "university", "company", "country",
    "province", "city", "village", "station", "port",
]

QUALIFIERS = ["literally", "the", "great", "greatest", "holy", "divine", "sacred"]

INSTITUTION_WORDS = [
    "observatory", "institution", "institute", "university", "college", "academy", "newspaper", "advertiser", "journal",
    "gazette", "railway", "company", "corporation", "government", "commission", "museum", "society",
]

STATE_TYPES = {
    "stateful": ["clothing", "expression", "mannerism", "equipment", "injury", "dirt", "wetness", "pose"],
    "stable": ["age", "height", "build", "hair", "facial_hair", "eyes", "complexion", "face", "distinctive_mark"],
    "contextual": ["weather", "terrain", "light", "atmosphere", "material"],
}

HEADING_KEYWORDS = ["chapter", "section", "part", "appendix", "prologue", "epilogue"]

#: Readings of a mis-scanned character in a numeral.
NUMERAL_VARIANTS = {"0": "O", "1": "IL", "L": "I", "I": "L1", "V": "Y", "Y": "V", "X": "K", "K": "X", "C": "G", "G": "C", "D": "O", "O": "D"}

BUILD = "(?:tall|short|large|small|slender|thin|lean|slight|stout|stocky|broad|muscular|powerful|robust|strong|weak|lanky|massive|heavy|delicate)"
HAIR = "(?:long|short|thick|thin|curly|straight|wavy|dark|black|brown|fair|blond|blonde|grey|gray|white|red|auburn)"
EXPRESSION = "(?:smiling|smiled|laughing|laughed|angry|furious|frightened|afraid|terrified|calm|anxious|worried|sad|joyful|cheerful|stern|serious|grave|excited|astonished|surprised)"
DEGREE = "(?:very|quite|rather|extremely|remarkably|slightly)"
MEASURE = r"\d+\s*(?:feet|foot|ft|inches|inch|in|metres|meters|m|cm)"

MANNERISM_VERBS = "(?:walked|walks|spoke|speaks|looked|looks|kept|keeps|took|takes|carried|carries|held|holds|stood|stands|went|goes|sat|sits|smoked|smokes|laughed|laughs|smiled|smiles|watched|watches|hunted|hunts|travelled|traveled|travel|rode|rides|remained|remains|returned|returns|followed|follows|guarded|guards|observed|observes|examined|examines|congratulated|congratulates|yielded|yields|preferred|prefers|used|uses)"

#: (category, attribute, pattern with {name} for the quoted name, group, method); the first match of an attribute wins.
FACT_RULES = [
    ("appearance", "build", rf"\b{{name}}\b[^,;:!?]{{{{0,100}}}}\b(?:was|were|is|are|looked|appeared|seemed|stood)\s+(?:to be\s+)?((?:{DEGREE})?\s*{BUILD})\b", 1, "character_subject_build"),
    ("appearance", "build", rf"\b((?:{DEGREE})?\s*{BUILD})\s+(?:man|woman|person|figure|fellow|hunter|astronomer|colonel|professor|doctor)\b[^,;:!?]{{{{0,100}}}}\b{{name}}\b", 1, "character_subject_build"),
    ("appearance", "height", rf"\b{{name}}\b[^,;:!?]{{{{0,100}}}}\b(?:was|were|stood|measured)\s+(?:about|nearly|approximately)?\s*({MEASURE})\b", 1, "character_subject_height"),
    ("appearance", "height", rf"\b({MEASURE})\s+(?:high|tall)\b[^,;:!?]{{{{0,100}}}}\b(?:man|woman|person|figure)\b[^,;:!?]{{{{0,100}}}}\b{{name}}\b", 1, "character_subject_height"),
    ("appearance", "hair", rf"\b{{name}}\b[^.;!?]{{{{0,100}}}}\b({HAIR}\s+(?:hair|locks|tresses))\b", 1, "character_subject_hair"),
    ("appearance", "hair", rf"\b({HAIR}\s+(?:hair|locks|tresses))\b[^.;!?]{{{{0,100}}}}\b{{name}}\b", 1, "character_subject_hair"),
    ("appearance", "facial_hair", r"\b{name}\b[^.;!?]{{0,100}}\b((?:long|short|full|thick|heavy|bushy|black|brown|grey|gray|white|red)?\s*(?:beard|moustache|mustache|whiskers))\b", 1, "character_subject_facial_hair"),
    ("appearance", "eyes", r"\b((?:blue|green|grey|gray|brown|black|hazel|dark|bright|deep|large|small|piercing|keen|sharp)\s+eyes?)\b", 1, "character_subject_eyes"),
    ("appearance", "complexion", r"\b((?:pale|fair|dark|ruddy|florid|sallow|swarthy|tanned|sunburnt|sunburned|weathered|fresh|healthy|worn|haggard)\s+(?:face|complexion|skin))\b", 1, "character_subject_complexion"),
    ("appearance", "face", r"\b((?:round|oval|long|broad|thin|narrow|square|angular|handsome|ugly|rugged|stern|kind|intelligent|expressive)\s+(?:face|features|countenance))\b", 1, "character_subject_face"),
    ("clothing", "clothing", r"\b(?:wearing|wore|dressed in|clad in|attired in)\s+([^.;!?]{{3,100}})", 1, "character_subject_clothing"),
    ("expression", "expression", rf"\b({EXPRESSION})\b[^.;!?]{{{{0,45}}}}\b(?:face|features|countenance|expression|look|air|manner)\b", 1, "character_subject_expression"),
    ("expression", "expression", rf"\b(?:face|features|countenance|expression|look|air|manner)\b[^.;!?]{{{{0,45}}}}\b({EXPRESSION})\b", 1, "character_subject_expression"),
    ("mannerism", "mannerism", rf"\b((?:always|often|usually|habitually|constantly)\b[^.;!?]{{{{0,100}}}}\b{MANNERISM_VERBS}\b[^.;!?]{{{{0,80}}}})", 1, "source_mannerism_local"),
    ("appearance", "distinctive_mark", r"\b((?:scars?|birthmark|tattoo)[^.;!?]{{0,80}})", 1, "character_subject_mark"),
]

ACTION = r"(?i)\b(?:approach\w*|arriv\w*|attack\w*|battle\w*|captur\w*|climb\w*|come|cross\w*|cry\w*|die\w*|enter\w*|fall\w*|flee\w*|follow\w*|fight\w*|grab\w*|hold\w*|kill\w*|look\w*|move\w*|open\w*|reach\w*|return\w*|run\w*|save\w*|see\w*|sit\w*|stand\w*|take\w*|turn\w*|walk\w*|watch\w*|travel\w*|strike\w*|destroy\w*|burn\w*|collapse\w*|kneel\w*|rise\w*|speak\w*)\b"
PRESENCE = r"(?i)\b(?:was|were|is|are|stood|sat|lay|remained|waited|rested|entered|arrived|appeared|left|returned|looked|watched|faced|knelt|rose|walked|ran|fled|followed|held|carried|spoke|sang|wept|cried)\b"
DESTRUCTION = r"(?i)\b(?:ruin|ruined|destroyed|destruction|ashes|ash|embers|burnt|burned|fire|smoke|collapse|collapsed|wreck|wreckage|dead|dying|death)\b"
COMBAT = r"(?i)\b(?:battle|fight|fought|attack|attacked|strike|struck|weapon|sword|kill|killed|capture|captured)\b"
TRAVEL = r"(?i)\b(?:walk|walked|run|ran|travel|travelled|traveled|arrive|arrived|leave|left|cross|crossed|journey)\b"
REACTION = r"(?i)\b(?:fear|afraid|frightened|angry|furious|grief|sad|wept|cried|shocked|astonished|surprised|regret|regretted)\b"

#: Roles and the words that tell them, the first that fits.
ROLES = [
    ("deity", r"(?i)\b(?:lord|deity|god|goddess|shiva|vishnu|indra|brahma|deva|devi)\b"), ("warrior", r"(?i)\b(?:warrior|soldier|fighter|champion|guard)\b"),
    ("ruler", r"(?i)\b(?:king|queen|ruler|emperor|empress|prince|princess|chief)\b"), ("ascetic", r"(?i)\b(?:ascetic|sage|rishi|guru|mendicant|monk|hermit|yogi)\b"),
    ("elder", r"(?i)\b(?:elder|aged|ancient|grandfather|grandmother)\b"),
]

#: What a role lets one suppose, of whatever genre.
ROLE_PRIORS = {
    "person": ["natural human proportions", "credible posture and body language for the narrative role"],
    "warrior": ["physically capable posture appropriate to the narrative role", "practical period-appropriate equipment only when source context supports it"],
    "ruler": ["composed, authoritative presence appropriate to the story world", "status-aware clothing only when supported by the source context"],
    "deity": ["commanding presence appropriate to the established belief or mythic context", "ceremonial or symbolic styling only where source context supports it"],
    "ascetic": ["disciplined, restrained presentation appropriate to the narrative role"],
    "elder": ["mature, dignified presence without inventing an exact age"],
}

#: What a genre lets one suppose.
GENRE_BASELINES = {
    "general_narrative": [
        "cinematic presentation appropriate to the supplied story world", "physically plausible anatomy, materials, lighting, and environment",
        "do not introduce culture-, religion-, period-, or country-specific details unless source context supports them",
    ],
    "mythology": [
        "cinematic mythic presentation appropriate to the source's identified cultural and religious context", "period-appropriate materials and garments only when supported by the world context",
        "no modern objects, architecture, typography, or technology unless source-supported",
    ],
    "historical": [
        "historically appropriate visual presentation using the detected region and period", "material culture should follow source-supported historical context",
        "avoid anachronistic modern objects or styling unless source-supported",
    ],
    "biography": ["visual presentation appropriate to the source person's documented time, place, and social context", "do not fictionalize unsupported appearance or events"],
    "patriotic": [
        "visual presentation appropriate to the detected national, historical, and political context",
        "use flags, uniforms, insignia, or national symbols only when source-supported or strongly established by the world context",
    ],
    "fantasy": ["cinematic fantasy presentation while preserving the source's established rules and setting", "fantastical elements must be source-supported rather than freely invented"],
    "crime_thriller": ["cinematic thriller presentation appropriate to the detected location and period", "realistic contemporary details only when supported by source context"],
    "science_fiction": ["cinematic science-fiction presentation consistent with the source's technological and temporal rules", "do not invent technology beyond the established story world"],
}

#: (attribute, words of which a supposed value holds one, or starts with where marked by ^): the first that fits.
PRIOR_ATTRIBUTES = [
    ("physique", ["physique", "anatomy"]), ("presentation", ["presence", "presentation", "styling", "body language", "posture"]), ("costume_direction", ["garment", "clothing"]),
    ("world_context", ["^detected "]), ("environment_rules", ["modern", "materials", "technology"]),
]

#: Attributes of facts and the attribute of priors that they settle.
ATTRIBUTE_ALIASES = {
    "build": "physique", "body_type": "physique", "clothing": "costume_direction", "attire": "costume_direction", "garments": "costume_direction",
    "eyes": "eye_color", "face": "face_geometry", "expression": "presentation",
}

#: Traits of identity that are unknown unless the source tells them, and those that no prior may speak of.
IDENTITY_TRAITS = ["eye_color", "hair_color", "exact_height", "exact_age", "facial_measurements"]
NEVER_SUPPOSED = ["eye_color", "hair_color", "exact_age", "exact_height", "facial_measurements"]


def any_of(words: list[str]) -> str:
    """A pattern group that matches one of words."""
    return "(?:" + "|".join(words) + ")"
