"""They must equal the source system's for results to match."""

# Terms dropped by the part-of-speech filter.
STOP_TERMS = ["", "是", "的", "得", "了"]

# Term classes dropped by name, then by first letter.
DROPPED_CLASSES = ["null", "vshi", "vyou"]
DROPPED_CLASS_LETTERS = ["t", "f", "r", "m", "q", "d", "p", "c", "u", "e", "y", "o", "h", "k", "x", "w"]

# Class and priority bonus of user terms.
USER_TERM_CLASS = "nwt"
USER_TERM_BONUS = 1000

# Dictionaries of these categories are switched off; terms with this prefix are deleted.
SILENCED_CATEGORIES = [
    "游戏", "娱乐", "武侠", "个人", "收藏", "机器猫", "搜狗细胞词库", "哲学", "玄幻", "其它", "文学", "方言",
]
DELETED_TERM_PREFIX = "的"

# A lexicon term has fewer UTF-8 bytes than this; these characters are removed from it.
TERM_BYTES_BELOW = 17
LEXICON_NOISE = "[a-z,A-Z]"

# Script and style blocks removed before a page is read.
SCRIPT_BLOCK = r"(?i)<[\s]*?script[^>]*?>[\s\S]*?<[\s]*?\/[\s]*?script[\s]*?>"
STYLE_BLOCK = r"(?i)<[\s]*?style[^>]*?>[\s\S]*?<[\s]*?\/[\s]*?style[\s]*?>"

# Where an encyclopedia page keeps its text (the last present one counts) and its tags.
CONTENT_SELECTORS = [".body-wrapper", "#sec-content0"]
TAG_SELECTOR = "#open-tag-item"
TAG_SEPARATOR = "，"

# How often title, tags, keywords and body count in the text of a page.
FIELD_WEIGHTS = {"title": 4, "tags": 3, "keyword": 2, "content": 1}

# Parts of a dictionary list page.
DICT_BLOCK = ".dict_detail_block"
DICT_TITLE = ".detail_title"
DICT_CELL = ".show_content"
DICT_LINK_PREFIX = "/dict/detail/index/"
PAGER_SELECTOR = "#dict_page_list"
PAGER_LINK_PREFIX = "/dict/cate/index/"
PAGER_SKIPPED = ["上一页", "下一页", "1"]
DICT_COUNT_ABOVE = 2000

# Classifier defaults.
TOP_TERMS = 200
CLASS_LIMIT = 200
CLASS_MIN_COUNT = 500
CLASS_SKIP = 5
SMOOTHING = 1.0
