"""Fixed values that must equal the reference's for the same results."""

# --- fixed values (kept exactly as the reference uses them) -------------------

# Event types kept by the yearly user -> repository jobs.
ACTIVITY_TYPES = ("WatchEvent", "CommitCommentEvent", "ForkEvent")

# Event type counted by the weekly trending job.
TREND_TYPE = "WatchEvent"

# Event types of the prototype user -> {repo: time} job.
PROTOTYPE_TYPES = ("WatchEvent", "PushEvent")

# Year label -> the per-year tables it reads, in the reference's order.
YEAR_LABEL_PARTS = {
    "2015": ("2015",),
    "2014": ("2014_1", "2014_2"),
    "2013": ("2013",),
    "2012": ("2012",),
    "Dec. 2011": ("2011",),
    "All": ("2011", "2012", "2013", "2014_1", "2014_2", "2015"),
}

# Constant leaf size attached to every repository node of the tree answer.
LEAF_SIZE = 10000

# Number of rows in the trending answer.
TOP_K = 10

# Pages of a follow list that survive the API crawler's request budget (the
# 10th is fetched but discarded); pass it to ``stitch_pages`` for its results.
MAX_PAGES = 9

# Status answers of the ego-graph and id lookups.
STATUS_OK = "ok"
STATUS_NOT_FOUND = "not_found"
STATUS_NOT_FOLLOWING = "not_following"
MSG_NOT_FOUND = "Records for {user} were not found"
MSG_NOT_FOLLOWING = "{user} is not following anyone"
MSG_NOT_IN_DB = "{user} is not in the database"

# Class of the headings that hold the links of stored follow pages.
FOLLOW_LINK_CLASS = "follow-list-name"

# Timeline timestamps: ISO-8601 with "Z" or an offset, with or without
# fractions, and the older slash form.
CREATED_AT_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssXXX",
                      "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy/MM/dd HH:mm:ss XX")

# Topic of landed messages without a topic or a readable time.
REJECTS = "_rejects"

# Reject reasons.
REJECT_CORRUPT = "corrupt"
REJECT_NULL_USER = "null_user"
REJECT_NULL_REPO = "null_repo"
REJECT_BAD_TIME = "bad_time"
