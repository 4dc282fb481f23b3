"""Constants, word lists and patterns that decide results.

Every literal here must keep exactly this value for results to agree with the
published behaviour, so they are stated plainly and in one place.
"""

# --- trust and decision thresholds (fixed values) ---------------------------
AUTO_LINK_SCORE = 90
REVIEW_LOW_SCORE = 78
TRUST_CONFIDENCE = 0.85
FLEXIBLE_CONFIDENCE = 0.85
EXACT_CONFIDENCE = 0.97
WORTH_IT_SAVING = 10.0
WORTH_IT_SHARE = 0.08
MAX_REASON_CHARS = 500
CITED_PRICE_IDS = 20
FACT_MISSING_LABELS = 5
CANDIDATES_PER_TERM = 5
REPORT_ROWS = 25

# --- stored words (fixed values) --------------------------------------------
METHOD_SEED = "seed"
METHOD_NEW = "new"
METHOD_FUZZY = "rapidfuzz"
METHOD_ADJUDICATED = "llm_adjudicator"
DECIDED_BY_MODEL = "llm"
DECIDED_BY_HUMAN = "human"
PARSER_VERSION = "v1"

# --- per-source price confidence (fixed values) ------------------------------
SOURCE_CONFIDENCE = {
    "kroger": 0.99,
    "wholefoods": 0.90,
    "traderjoes": 0.90,
    "aldi_kcl": 0.80,
}
DEFAULT_SOURCE_CONFIDENCE = 0.75

# --- source dimension (fixed values) ------------------------------------------
# source | banner | chain parent | access method | confidence tier
SOURCES = [
    ("kroger", "Harris Teeter / Kroger", "Kroger", "api", "gold"),
    ("wholefoods", "Whole Foods Market", "Amazon", "scrape", "high"),
    ("lidl", "Lidl", "Lidl", "scrape", "high"),
    ("aldi_kcl", "Aldi", "Aldi", "aggregator", "medium"),
    ("giant", "Giant", "Ahold", "aggregator", "medium"),
    ("safeway", "Safeway", "Albertsons", "aggregator", "medium"),
]
DEMO_EXTRA_SOURCE = ("traderjoes", "Trader Joe's", "Trader Joe's", "scrape", "high")

# --- which pending artifacts are parsed (fixed values) -------------------------
# source -> (JSON path in the request parameters, wanted value), or None for all
PARSED_SOURCES = {
    "kroger": ("$.endpoint", "products"),
    "aldi_kcl": None,
    "wholefoods": None,
    "traderjoes": None,
}

# --- URL policy (fixed values) --------------------------------------------------
DENIED_PREFIXES = ["/tag", "/api/", "/search", "/webview"]
DENIED_PARAMETER = "kclt="

# --- store locator (fixed values) ---------------------------------------------
PREFERRED_CHAIN_CODE = "HART"
PREFERRED_BANNER_NAME = "HARRIS TEETER"

# --- deal blob in HTML (fixed values) ------------------------------------------
DEAL_MARKER = '"_id":[0,"'
DEAL_FIELDS = {
    "name": r'"name":\[0,"((?:[^"\\]|\\.)*)"\]',
    "regular_price": r'"regularPrice":\[0,([\d.]+)\]',
    "price": r'"discountPrice":\[0,([\d.]+)\]',
    "discount_type": r'"discountType":\[0,"([^"]*)"\]',
    "quantity": r'"quantity":\[0,([\d.]+)\]',
    "url": r'"url":\[0,"([^"]*)"\]',
}
DEAL_SKU = r"/products/(\d+)-"
DEAL_REQUIRED_TEXT = '"discountPrice"'

# --- leaflet links (fixed values) ------------------------------------------------
LEAFLET_BASE = "https://www.lidl.com"
LEAFLET_PATH = "/flyer/esi-flyer/"
DATE_RANGE = r"(\d{1,2}/\d{1,2}/\d{4})\s*-\s*(\d{1,2}/\d{1,2}/\d{4})"

# --- package sizes: unit word -> base units it holds (fixed values) -------------
VOLUME_UNITS = {  # base fl_oz
    "fl oz": 1.0, "floz": 1.0, "fl. oz": 1.0, "fluid ounce": 1.0, "fluid ounces": 1.0,
    "pt": 16.0, "pint": 16.0, "pints": 16.0,
    "qt": 32.0, "quart": 32.0, "quarts": 32.0,
    "gal": 128.0, "gallon": 128.0, "gallons": 128.0,
    "l": 33.814, "liter": 33.814, "litre": 33.814, "liters": 33.814,
    "ml": 0.033814, "milliliter": 0.033814, "milliliters": 0.033814,
}
WEIGHT_UNITS = {  # base oz
    "oz": 1.0, "ounce": 1.0, "ounces": 1.0,
    "lb": 16.0, "lbs": 16.0, "pound": 16.0, "pounds": 16.0,
    "g": 0.035274, "gram": 0.035274, "grams": 0.035274,
    "kg": 35.274, "kilogram": 35.274, "kilograms": 35.274,
}
COUNT_UNITS = {  # base ct
    "ct": 1.0, "count": 1.0, "cnt": 1.0,
    "pk": 1.0, "pack": 1.0, "pks": 1.0,
    "ea": 1.0, "each": 1.0,
}

# --- name normalization (fixed values) --------------------------------------------
TRADEMARKS = "[®™©]"
PARENTHESES = r"\([^)]*\)"
NAME_SIZE_TOKENS = (
    r"\b\d+(?:\.\d+)?\s*(?:fl\s*oz|oz|lb|lbs|pound|gal|gallon|qt|pt|ml|l|ct|count"
    r"|pk|pack|g|kg|ea|each)\b"
)

# --- coarse categories, first matching rule wins (fixed values) --------------------
COARSE_CATEGORIES = [
    "produce", "protein", "dairy", "snack", "pantry", "frozen", "household",
]
HINT_RULES = [
    ("frozen", "frozen"),
    ("household|cleaning|paper goods|personal care|health|beauty|baby|pet|floral", "household"),
    ("snack|candy|chips|cookies", "snack"),
    ("produce|fruit|vegetable", "produce"),
    ("meat|seafood|poultry|deli|plant.?based", "protein"),
    ("dairy|eggs|cheese", "dairy"),
    (
        "pantry|bakery|bread|baking|breakfast|cereal|canned|condiment|sauce|dips"
        "|pasta|grain|rice|international|beverage|coffee|tea|soda|juice|water"
        "|wine|beer|spirits|liquor|adult beverage",
        "pantry",
    ),
]
NAME_RULES = [
    (
        "detergent|cleaner|soap|shampoo|conditioner|lotion|sunscreen|deodorant"
        "|toothpaste|toothbrush|paper towels?|toilet paper|napkins?|tissues?"
        "|foil|trash bags?|storage bags?|sponges?|candles?|batter(?:y|ies)"
        r"|diapers?|wipes|dishwash\w*|bleach|air freshener",
        "household",
    ),
    ("frozen|ice cream|popsicles?|sherbet|sorbet|gelato", "frozen"),
    (
        "crackers?|chips?|cook(?:ie|ies)|cand(?:y|ies)|pretzels?|popcorn"
        "|gumm(?:y|ies)|licorice|trail mix|jerky|fruit snacks?|snack bars?"
        "|granola bars?|chocolates?|brownies?|donuts?|doughnuts?|pudding",
        "snack",
    ),
    (
        "broths?|stocks?|soups?|bouillon|gravy|sauces?|salsa|dressings?"
        "|seasonings?|spices?|extracts?|syrups?|breads?|bagels?|buns?|rolls?"
        "|tortillas?|noodles?|pasta|cereal|oatmeal|granola|flour|sugar"
        "|mix|mixes|juices?|soda|coffee|tea|ketchup|mustard|mayonnaise|jam"
        "|jelly|honey|rice|beans?|lentils?|oil|vinegar|peanut butter|cakes?"
        "|pies?|muffins?|croissants?|crusts?|frosting|creamer",
        "pantry",
    ),
    (
        "bananas?|apples?|oranges?|grapes?|berr(?:y|ies)|strawberr(?:y|ies)"
        "|blueberr(?:y|ies)|melons?|watermelons?|peach(?:es)?|pears?|plums?"
        "|nectarines?|mango(?:e?s)?|pineapples?|avocado(?:e?s)?|lemons?|limes?"
        "|potato(?:e?s)?|onions?|carrots?|tomato(?:e?s)?|lettuce|spinach|kale"
        "|broccoli|cauliflower|celery|cucumbers?|peppers?|zucchini|squash"
        "|mushrooms?|garlic|ginger|corn|salad|greens|herbs?|cilantro|asparagus",
        "produce",
    ),
    (
        "chicken|beef|pork|turkey|lamb|salmon|tilapia|cod|tuna|shrimp|crab"
        "|fish|bacon|sausages?|ham|steaks?|drumsticks?|thighs?|breasts?"
        "|wings?|ribs?|brisket|meatballs?|tofu|tempeh|hot ?dogs?|franks?",
        "protein",
    ),
    (
        "milk|cheese|cheddar|mozzarella|parmesan|swiss|provolone|gouda|feta"
        "|yogurt|butter|eggs?|cream|half & half|half and half|cottage cheese"
        "|sour cream|cream cheese",
        "dairy",
    ),
]

# --- list terms (fixed values) ------------------------------------------------------
FALSE_FRIENDS = (
    "pudding|marshmallow|candle|sunscreen|scented|shampoo|detergent|lotion"
    r"|candy|candies|juice|soda|drink|\bmix\b|cake|frosting|creamer|cocktail|flavored"
)
LIST_TO_COARSE = {
    "produce": "produce",
    "dairy": "dairy",
    "protein": "protein",
    "staples": "pantry",
    "snacks": "snack",
}

# --- numbers in written summaries (fixed values) --------------------------------------
ISO_DATE = r"\b\d{4}-\d{2}-\d{2}\b"
DOLLARS = r"\$\s?([\d,]+(?:\.\d{1,2})?)"
NUMBER = r"\b\d+(?:\.\d+)?\b"
FACT_VIEWS = ["gold_current_prices", "gold_basket_item_cost"]

# --- demo shopping list: category, label, keyword, quantity (fixed values) -----------
SHOPPING_LIST = [
    ("produce", "bananas", "banana", 2),
    ("produce", "apples", "apple", 1),
    ("produce", "potatoes", "russet potato", 1),
    ("produce", "onions", "yellow onion", 1),
    ("produce", "carrots", "carrot", 1),
    ("produce", "tomatoes", "tomato", 1),
    ("produce", "lettuce", "lettuce", 1),
    ("produce", "broccoli", "broccoli", 1),
    ("dairy", "milk", "milk", 2),
    ("dairy", "eggs", "egg", 1),
    ("dairy", "butter", "butter", 1),
    ("dairy", "yogurt", "yogurt", 2),
    ("dairy", "cheese", "cheddar", 1),
    ("protein", "chicken", "chicken breast", 2),
    ("protein", "ground beef", "ground beef", 1),
    ("protein", "salmon", "salmon", 1),
    ("protein", "bacon", "bacon", 1),
    ("staples", "rice", "rice", 1),
    ("staples", "pasta", "pasta", 2),
    ("staples", "bread", "bread", 2),
    ("staples", "cereal", "cereal", 2),
    ("staples", "peanut butter", "peanut butter", 1),
    ("staples", "olive oil", "olive oil", 1),
    ("snacks", "crackers", "cracker", 1),
    ("snacks", "chips", "chips", 1),
    ("snacks", "cookies", "cookie", 1),
]

# --- demo catalogue (fixed values) ---------------------------------------------------------
# label, name, size, and for each source that carries it the price and the confidence of the match
DEMO_CATALOG = [
    ("bananas", "Bananas", "per lb",
     {"kroger": (0.59, 1.0), "wholefoods": (0.69, 0.99), "traderjoes": (0.23, 0.97), "aldi_kcl": (0.44, 0.9)}),
    ("apples", "Gala Apples", "3 lb bag",
     {"kroger": (4.49, 1.0), "wholefoods": (5.49, 0.99), "traderjoes": (4.29, 0.97), "aldi_kcl": (3.29, 0.9)}),
    ("potatoes", "Russet Potatoes", "5 lb bag",
     {"kroger": (3.99, 1.0), "wholefoods": (5.99, 0.99), "traderjoes": (4.49, 0.97), "aldi_kcl": (2.85, 0.9)}),
    ("onions", "Yellow Onions", "3 lb bag",
     {"kroger": (2.99, 1.0), "wholefoods": (3.99, 0.99), "traderjoes": (2.79, 0.97), "aldi_kcl": (2.15, 0.9)}),
    ("carrots", "Carrots", "2 lb bag",
     {"kroger": (1.99, 1.0), "wholefoods": (2.49, 0.99), "traderjoes": (1.79, 0.97), "aldi_kcl": (1.45, 0.9)}),
    ("tomatoes", "Roma Tomatoes", "per lb",
     {"kroger": (1.79, 1.0), "wholefoods": (2.49, 0.99), "traderjoes": (1.99, 0.97), "aldi_kcl": (1.25, 0.9)}),
    ("lettuce", "Romaine Lettuce Hearts", "3 ct",
     {"kroger": (3.49, 1.0), "wholefoods": (4.29, 0.99), "traderjoes": (3.29, 0.97), "aldi_kcl": (2.89, 0.9)}),
    ("broccoli", "Broccoli Crowns", "per lb",
     {"kroger": (2.29, 1.0), "wholefoods": (2.99, 0.99), "traderjoes": (2.49, 0.97)}),
    ("milk", "Whole Milk", "1 gal",
     {"kroger": (3.79, 1.0), "wholefoods": (4.79, 0.99), "traderjoes": (3.99, 0.97), "aldi_kcl": (3.15, 0.9)}),
    ("eggs", "Large Eggs", "12 ct",
     {"kroger": (3.29, 1.0), "wholefoods": (4.49, 0.99), "traderjoes": (2.99, 0.97), "aldi_kcl": (2.65, 0.9)}),
    ("butter", "Salted Butter", "16 oz",
     {"kroger": (4.49, 1.0), "wholefoods": (5.49, 0.99), "traderjoes": (3.99, 0.97), "aldi_kcl": (3.75, 0.9)}),
    ("yogurt", "Greek Yogurt", "32 oz",
     {"kroger": (4.99, 0.9), "wholefoods": (5.99, 0.99), "traderjoes": (5.49, 0.97), "aldi_kcl": (4.29, 0.9)}),
    ("cheese", "Sharp Cheddar", "8 oz",
     {"kroger": (2.99, 1.0), "wholefoods": (4.99, 0.99), "traderjoes": (3.49, 0.97), "aldi_kcl": (2.49, 0.9)}),
    ("chicken", "Boneless Chicken Breast", "per lb",
     {"kroger": (3.49, 1.0), "wholefoods": (6.99, 0.99), "traderjoes": (5.99, 0.97), "aldi_kcl": (2.89, 0.9)}),
    ("ground beef", "Ground Beef 80/20", "per lb",
     {"kroger": (4.99, 1.0), "wholefoods": (6.99, 0.99), "traderjoes": (5.49, 0.97), "aldi_kcl": (4.15, 0.9)}),
    ("salmon", "Atlantic Salmon Fillet", "per lb",
     {"kroger": (9.99, 1.0), "wholefoods": (12.99, 0.99), "traderjoes": (11.49, 0.97)}),
    ("bacon", "Hickory Smoked Bacon", "16 oz",
     {"kroger": (5.99, 1.0), "wholefoods": (7.99, 0.99), "traderjoes": (5.49, 0.97), "aldi_kcl": (4.45, 0.9)}),
    ("rice", "Jasmine Rice", "5 lb",
     {"kroger": (6.49, 1.0), "wholefoods": (8.99, 0.99), "traderjoes": (7.99, 0.97), "aldi_kcl": (5.49, 0.9)}),
    ("pasta", "Penne Pasta", "16 oz",
     {"kroger": (1.29, 1.0), "wholefoods": (1.99, 0.99), "traderjoes": (1.49, 0.97), "aldi_kcl": (0.95, 0.9)}),
    ("bread", "Whole Wheat Bread", "20 oz loaf",
     {"kroger": (2.79, 1.0), "wholefoods": (3.99, 0.99), "traderjoes": (2.99, 0.97), "aldi_kcl": (1.95, 0.9)}),
    ("cereal", "Honey Oat Cereal", "18 oz",
     {"kroger": (3.49, 0.9), "wholefoods": (4.99, 0.99), "traderjoes": (3.99, 0.97), "aldi_kcl": (2.79, 0.9)}),
    ("peanut butter", "Creamy Peanut Butter", "16 oz",
     {"kroger": (2.99, 1.0), "wholefoods": (4.49, 0.99), "traderjoes": (2.49, 0.97), "aldi_kcl": (2.15, 0.9)}),
    ("olive oil", "Extra Virgin Olive Oil", "16.9 fl oz",
     {"kroger": (8.99, 1.0), "wholefoods": (11.99, 0.99), "traderjoes": (7.99, 0.97), "aldi_kcl": (6.95, 0.9)}),
    ("crackers", "Cheese Crackers", "12.4 oz",
     {"kroger": (3.29, 1.0), "wholefoods": (4.49, 0.99), "aldi_kcl": (2.35, 0.9)}),
    ("chips", "Tortilla Chips", "13 oz",
     {"kroger": (3.79, 1.0), "wholefoods": (4.29, 0.99), "traderjoes": (2.99, 0.97), "aldi_kcl": (2.25, 0.9)}),
    ("cookies", "Chocolate Chip Cookies", "13 oz",
     {"kroger": (3.99, 1.0), "wholefoods": (5.49, 0.99), "traderjoes": (4.49, 0.97)}),
]
DEMO_REGULAR_PRICES = {
    ("chicken", "kroger"): 5.99,
    ("cheese", "kroger"): 4.29,
    ("apples", "aldi_kcl"): 4.19,
}
DEMO_STORES = {
    "kroger": ("HT-DEMO-1", "Harris Teeter Vienna (demo)"),
    "wholefoods": ("WFM-DEMO-1", "Whole Foods Vienna (demo)"),
    "traderjoes": ("TJ-DEMO-1", "Trader Joe's Vienna (demo)"),
    "aldi_kcl": ("ALDI-DEMO-1", "Aldi Vienna (demo)"),
}
DEMO_BASKET_NAME = "Demo family-of-four week (synthetic)"
DEMO_METHOD = "demo_seed"
