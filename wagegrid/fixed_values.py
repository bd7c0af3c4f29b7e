"""Fixed values.  These must stay as they are for results to agree."""

# --- fixed values: search pages -------------------------------------------
SEARCH_URL = "https://www.indeed.com/jobs?q=%s+%%2420%%2C000&l=%s&start=10&sort=date"
LISTING_URL = "http://www.indeed.com/jobs?q=data+scientist+%%2420%%2C000&l=%s&start=%s"
POSTING_URL = "https://www.indeed.com/viewjob?jk="
PAGE_STEP = 10
MAX_RESULTS_PER_PLACE = 2000

# --- fixed values: places searched ----------------------------------------
PLACES = [
    "New+York", "Chicago", "San+Francisco", "Austin", "Seattle",
    "Los+Angeles", "Philadelphia", "Atlanta", "Dallas", "Pittsburgh",
    "Portland", "Phoenix", "Denver", "Houston", "Miami", "Washington%2C+DC",
    "Charlottesville", "Richmond", "Baltimore", "Harrisonburg", "San+Antonio",
    "San+Diego", "San+Jose", "Austin", "Jacksonville", "Indianapolis",
    "Columbus", "Fort+Worth", "Charlotte", "Detroit", "El+Paso",
    "Memphis", "Boston", "Nashville", "Louisville", "Milwaukee", "Las+Vegas",
    "Albuquerque", "Tucson", "Fresno", "Sacramento", "Long+Beach", "Mesa",
    "Virginia+Beach", "Norfolk", "Atlanta", "Colorado+Springs",
    "Raleigh", "Omaha", "Oakland", "Tulsa", "Minneapolis", "Cleveland",
    "Wichita", "Arlington", "New+Orleans", "Bakersfield", "Tampa", "Honolulu",
    "Anaheim", "Aurora", "Santa+Ana", "Riverside", "Corpus+Christi",
    "Pittsburgh", "Lexington", "Anchorage", "Cincinnati", "Baton+Rouge",
    "Chesapeake", "Alexandria", "Fairfax", "Herndon", "Reston", "Roanoke",
]

# --- fixed values: words looked for in a title -----------------------------
TITLE_WORDS = [
    "Senior", "Manager", "Engineer", "Data Scientist", "Analyst",
    "Assistant", "Intern", "Developer", "Machine Learning",
]

# --- fixed values: salary texts --------------------------------------------
NO_SALARY = "None"
OTHER_UNITS = ("hour", "month")

# --- fixed values: formats ---------------------------------------------------
STAMP_FORMAT = "yyyyMMdd HH:mm"
DAY_FORMAT = "yyyyMMdd"

# --- fixed values: study parameters ------------------------------------------
FOLDS = 6
FOLDS_NEURAL_NET = 5
TITLE_TERMS = 30
SYNOPSIS_TERMS = 50
IMPORTANCE_ROWS = 20
TREES = 100
TFIDF_VOCABULARY = 3
TFIDF_MIN_ROWS = 2
HASH_BUCKETS = 100
SAMPLE_SHARE = 0.001

# --- fixed values: markup of a result card and of a posting page ------------
# field: (tag or None, attribute or None, wanted value or None, what to take)
CARD = [("div", "data-tn-component", "organicJob"), (None, "class", "result")]
CARD_FIELDS = {
    "company_name": ("span", "class", "company", "text"),
    "company_any": (None, "class", "company", "text"),
    "title_link": ("a", "data-tn-element", "jobTitle", "text"),
    "title_any": (None, "class", "jobtitle", "text"),
    "place": ("span", "class", "location", "text"),
    "salary_nobr": ("nobr", None, None, "text"),
    "salary_span": ("span", "class", "no-wrap", "text"),
    "summary": ("span", "class", "summary", "text"),
    "link_id": ("a", None, None, "id"),
}
POSTING_FIELDS = {
    "share_url": ("meta", "id", "indeed-share-url", "content"),
    "title": ("div", "class", "jobsearch-JobInfoHeader-title-container", "text"),
    "job_desc": ("div", "class", "jobsearch-jobDescriptionText", "html"),
    "company": ("a", "class", "jobsearch-CompanyAvatar-companyLink", "text"),
    "rating": ("meta", "itemprop", "ratingValue", "content"),
    "rating_count": ("meta", "itemprop", "ratingCount", "content"),
}
ID_PREFIX_LENGTH = 3

# --- fixed values: English stop words, the list Spark ships ------------------
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()
