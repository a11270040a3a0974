"""Words, characters and patterns of the cleaning rules."""

from __future__ import annotations

# What counts as white space in the rules, as the body of a character class.
WS = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Full-width letters and digits, their ASCII forms, and the spaces folded to U+0020.
FULL_WIDTH = "０１２３４５６７８９ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"
ASCII = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SPACES = "\u3000\u00a0\u2002\u2003\u2009"

# Edition words.
EDITION_WORDS = (
    "修订版", "增订版", "新版", "典藏版", "珍藏版", "精装版", "平装版", "图文版",
    "插图版", "彩图版", "注音版", "大字版", "双语版", "英汉对照", "全译版",
    "精装本", "平装本", "特签版", "印特签版", "刷边版", "毛边本", "亲签版",
    "第2版", "第3版", "第4版", "第5版", "第三版", "第四版", "第五版",
)

# Promotion markers.
PROMO_WORDS = (
    "正版书籍", "正版图书", "正版现货", "正版包邮", "正版", "当当自营", "当当专享",
    "当当独家", "当当定制", "限量亲签", "限量签名", "限量版", "亲签版", "签名版",
    "印签版", "印特签", "特签版", "刷边版", "印章版", "签章版", "藏书票", "明信片",
    "书签", "海报", "赠品",
    "附赠", "赠送", "包邮", "现货", "全新", "全新正版", "套装", "全店", "旗舰店",
    "自营店", "官方旗舰", "出版社直供", "新华书店", "天猫", "京东", "包发票",
    "速发", "秒杀", "预售", "团购", "批发", "特价", "清仓", "畅销", "好评",
    "网络原名", "全新力作", "重磅新书", "新书首发",
)

# Goods that are no books.
NON_BOOK_WORDS = (
    "会议平板", "触控一体机", "投影仪", "打印机", "学习机", "点读笔", "智能笔",
    "台灯", "书包", "文具", "玩具", "拼图", "积木", "手办", "盲盒", "挂历",
    "台历", "日历本", "笔记本子", "手账", "贴纸", "水杯", "抱枕", "帆布袋",
    "耳机", "键盘", "鼠标", "硬盘", "路由器", "充电宝", "数据线", "屏幕",
    "课程卡", "网课", "会员卡", "点卡", "优惠券", "代金券", "礼盒装茶叶",
    "窗帘", "床品", "厨具", "健身器材", "化妆品", "保健品", "食品",
)

# Words of tie-ins, genres, presses, roles, endorsements and series; volume units and numerals.
TIE_IN_WORDS = ("原著", "影视", "电视剧", "电影", "同名", "番外", "周边", "全本", "完结", "连载", "广播剧", "有声书", "外传", "前传")
GENRE_CHARS = "玄幻武侠都市历史军事青春言情科幻悬疑惊悚恐怖推理爱情仙侠奇幻战争穿越搞笑热血灵异权谋豪门宫斗宅斗年代空间系统"
PRESS_SUFFIXES = (
    "出版社", "出版公司", "出版集团", "书局", "书店", "印书馆", "大学出版社", "教育出版社",
    "文艺出版社", "少儿出版社", "人民出版社", "音像出版社",
)
TITLE_ROLES = ("等著", "等编著", "等主编", "等译", "编著", "主编", "著", "编", "译", "绘", "口述", "整理")
TAIL_ROLES = ("等著", "等编著", "等译", "著", "编著", "主编", "编", "译", "等")
AUTHOR_ROLES = (
    "等著", "等编著", "等主编", "等译", "等编", "著", "编著", "主编", "编选", "编", "译", "校注", "校点",
    "注疏", "笺注", "整理", "辑注", "辑校", "撰", "修", "纂", "口述", "绘", "摄影", "改编", "编译",
    "审校", "责任编辑",
)
ENDORSEMENTS = ("推荐", "著", "主编", "编著", "译", "出版社", "出品", "正版", "限量", "签名", "力荐")
SERIES_WORDS = ("系列", "丛书", "教材", "读本", "文库", "书系", "全集")
LISTING_PRESS = ("出版社", "出版公司", "出版集团", "书局", "书店", "印书馆", "公司", "集团", "大学")
VOLUME_UNITS, VOLUME_NUMERALS = "册卷部辑集", "0-9一两二三四五六七八九十百廿"
BAD_TITLE_WORDS = ("包邮", "客服", "发票", "运费", "拍下", "下单", "咨询", "联系客服")
NO_AUTHOR = ("无", "不详", "佚名", "未知", "匿名", "—", "-", "/")
ANONYMOUS = "佚名"

# Characters stripped from the ends of titles, heads and authors, and dropped from keys.
HEAD_STRIP = " ,，、/|·-—"
TITLE_STRIP = " :：,，.。、·—|/\\"
AUTHOR_STRIP = " ,，、/·"
KEY_DROP = "·・．.,，。:：;；!！?？\"'“”‘’()（）[]【】<>《》〈〉「」『』—–-~～/\\|*#%&@+_"

# How far a source's metadata is trusted; others 0.
SOURCE_PRIORITY = {"douban": 5, "weread": 4, "guji": 3, "dangdang": 2, "legacy": 1, "openlibrary": 1, "wikidata": 1}

# Thresholds.
MAX_PREFIX = 30
MIN_HAN, MAX_TITLE = 0.34, 60

HAN = "一-鿿"


def any_of(words: tuple[str, ...]) -> str:
    return "|".join(words)


def char_class(chars: str) -> str:
    """The body of a character class of literal characters."""
    return "".join("\\" + c if c in "\\[]^-&~" else c for c in chars)


S = f"[{WS}]"  # white space
D = r"\p{Nd}"  # a digit of any script
PROMO = any_of(PROMO_WORDS)
TIE_IN = any_of(TIE_IN_WORDS)
JUNK = (
    rf"¥|￥|{D}+(?:\.{D}+)?{S}*元|ISBN[{WS}:：]*[{D}\-Xx]{{10,17}}|(?<!{D})97[89]{D}{{10}}(?!{D})|"
    rf"{D}{{4}}{S}*年{S}*{D}{{1,2}}{S}*月(?:第{D}+次印刷)?|{D}{{3,4}}{S}*[开K]本|第{S}*{D}+{S}*次印刷|定价[:：]?{S}*{D}+"
)
PRESS = rf"(?:[{WS},，/]|^)[{HAN}·]{{2,15}}(?:{any_of(PRESS_SUFFIXES)})"
AUTHOR_BLOCK = rf"{S}(?:[{HAN}·]{{2,6}}|\[[^\]]{{1,8}}\][{HAN}·]{{0,6}}){S}*(?:{any_of(TITLE_ROLES)})"
GENRE = rf"{S}+[{GENRE_CHARS}]{{2,6}}小说$"
WRAP = rf"(?s)^[《〈「『【\[]{S}*(.+?){S}*[》〉」』】\]]$"
EDITION_PAREN = rf"[（(\[【]{S}*({any_of(EDITION_WORDS)}){S}*[）)\]】]"
EDITION_TAIL = rf"{S}*({any_of(EDITION_WORDS)})$"
SERIES = rf"[（(]{S}*[^（()）]{{2,30}}?(?:{any_of(SERIES_WORDS)}){S}*[）)]"
VOLUME = rf"[（(\[【]?{S}*(?:全{S}*)?[{VOLUME_NUMERALS}]+{S}*[{VOLUME_UNITS}]{S}*[）)\]】]?"
OPEN, CLOSE = r"[（(【\[]", r"[）)】\]]"
NOT_CLOSE = r"[^）)】\]]"
ASIDE = r"[，,。；;！!？?]"
KEY_DROP_CLASS = f"[{WS}{char_class(KEY_DROP)}]"
YEAR = rf"1[89]{D}{{2}}|20{D}{{2}}"
AUTHOR_DATE = rf"{D}{{4}}[-/年]{D}{{1,2}}|^{D}{{4}}$"
AUTHOR_ROLE = rf"[（(][^）)]{{0,12}}[）)]|(?:{any_of(AUTHOR_ROLES)})$"
AUTHOR_TAG = rf"^[\[(（][A-Za-z{HAN}]{{1,4}}[\]）)]"
AUTHOR_TAG_CUT = rf"^[\[(（]?[^\]]{{1,4}}[\]）)]?{S}*"
BAD_TITLE = rf"http|www\.|\.com|\.cn|￥|¥|{D}+\.{D}+{S}*元|{any_of(BAD_TITLE_WORDS)}"
ONLY_PUNCT = r"^[^\p{L}\p{N}]+$"
