"""Values that results depend on, stated as text. They are fixed by the publications' conventions."""

# --- fixed values: begin ---

PICK_ALIASES = {"top": "top", "顶部": "top", "上": "top", "bottom": "bottom", "尾部": "bottom", "底部": "bottom", "下": "bottom"}

CHARACTERS = {
    "０": "0", "１": "1", "２": "2", "３": "3", "４": "4", "５": "5", "６": "6", "７": "7", "８": "8", "９": "9",
    "\xa0": " ", "　": " ", "⒈": "1", "①": "1", "⑴": "1", "❶": "1",
    "絕": "绝", "殺": "杀", "開": "开", "綜": "综", "區": "区", "綠": "绿", "紅": "红", "藍": "蓝", "雙": "双", "單": "单", "準": "准", "碼": "码", "頭": "头",
    "【": "[", "】": "]", "《": "[", "》": "]", "（": "(", "）": ")", "：": ":", "？": "?",
}

TABLE_HEADERS = ("杀一尾", "绝杀一尾", "禁1尾", "禁尾", "尾数", "杀码尾")
SECTION_WORDS = ("综合绝杀区", "绝杀专区", "杀尾专区", "澳门综合全杀", "香港综合全杀")
SIGNAL_WORDS = (
    "绝杀一尾", "杀一尾", "稳杀一尾", "狠杀一尾", "主杀一尾", "禁一尾", "绝杀一个尾", "精准杀尾", "精杀一尾", "绝杀1尾", "绝杀①尾", "课杀一尾", "绝杀半波",
)
EXCLUDED_WORDS = (
    "平特一尾", "平特二尾", "二尾中特", "三尾中特", "四尾中特", "五尾中特", "六尾中特", "七尾中特", "尾数统计", "高手榜", "规律一尾", "公式平尾",
)
PRIOR_WORDS = ("上一期", "上期", "上周", "上回", "上轮", "上届", "前期", "前一", "往期", "往届", "昨日", "昨天")
CURRENT_WORDS = ("本期", "今期", "当期", "最新", "这期")
PRIOR_RESULT_WORDS = ("红单", "黑单", "命中", "中出", "中奖", "中特")
DRAW_NOISE_WORDS = ("公开", "开户", "开始", "开展", "开通", "开盘", "开奖栏目", "开奖时间", "开奖直播", "开奖记录", "开奖走势", "开奖网", "开奖站")
LOOK_BEHIND = 12
CHINESE_DIGITS = "零一二三四五六七八九"

ANIMALS = "鼠牛虎兔龙蛇马羊猴鸡狗猪"
ACTION = r"(?:绝\s*杀|精准\s*杀|稳\s*杀|狠\s*杀|主\s*杀|课\s*杀|杀\s*掉|禁|杀)"
VALUE_PATTERNS = (
    ACTION + r"\s*(?:一|①|1|一个)?\s*尾[^\d]{0,6}(\d{1,4})",
    ACTION + r"\s*(?:一|①|1|一个)?\s*[:：]?\s*[【\[《(（]?\s*(\d{1,4})\s*[】\]》)）]?\s*尾",
    ACTION + r"\s*(?:一|①|1|一个)?\s*尾\s*[【\[《(（]?\s*(\d{1,4})\s*[】\]》)）]?",
    ACTION + r"\s*(?:一|①|1|一个)?\s*尾\s*[:：=]\s*(\d{1,4})",
    r"(?:绝|精)\s*(?:一|①|1)\s*尾[^\d]{0,6}(\d{1,4})",
    r"(?:绝|精)\s*(?:一|①|1)\s*[:：]?\s*[【\[《(（]?\s*(\d{1,4})\s*[】\]》)）]?\s*尾",
)
LABEL_ITSELF = r"(?:绝杀|精准杀|稳杀|狠杀|主杀|课杀|杀掉|禁|杀)1尾"
SECOND_VALUE = r"\s*(?:尾\s*)?(?:[、,，.．+＋/]\s*)?\d\s*尾"
ISSUE = r"(?<!\d)(\d{1,4})\s*期"
ISSUE_START = r"(?=(?<!\d)\d{1,4}\s*期)"
DRAW_TEXT = r"开\s*[:：?？]?\s*([^\s\[\]<>|，,。；;]{1,24})"
DRAW_BOUNDARY = r"开\s*[:：?？]?\s*(?=(?:[鼠牛虎兔龙蛇马羊猴鸡狗猪]\s*)?\d|\?)"
DRAW_FIELD_BOUNDARY = r"开(?:奖结果|奖号码|奖)?\s*[:：?？]?\s*(?=(?:[鼠牛虎兔龙蛇马羊猴鸡狗猪])?\d|\?)"
DRAW_FIELD = (
    r"开(?:奖结果|奖号码|奖)?[ \t:：]*(?:(?:[鼠牛虎兔龙蛇马羊猴鸡狗猪])?\d{1,4}|[?？]{1,2}\d{0,2}|准|错)"
    r"|(?:[鼠牛虎兔龙蛇马羊猴鸡狗猪]\s*\d{2}\s*(?:准|错))"
    r"|(?:[【\[]?\s*\d+\s*[】\]]?\s*[尾头肖]\s*[：:]\s*(?:[鼠牛虎兔龙蛇马羊猴鸡狗猪]\s*\d{2}|[?？]{1,2}\d{0,2}|\d{1,4})\s*(?:准|错))"
)
DRAW_URL = r"开奖\s*[:：]?\s*\d+\s*\.\s*[A-Za-z]{2,}"
WAVE = r"(红波单|红波双|蓝波单|蓝波双|绿波单|绿波双|红单|红双|蓝单|蓝双|绿单|绿双)"
FEED_ROW = (
    r"(?<!\d)(\d{1,4})\s*期\s*[:：]?\s*(?:x\s*)?" + ACTION + r"?\s*(?:一个|一|①|1)?\s*尾\s*[:：=]*\s*[\[(【《]?\s*(\d{1,3})\s*(?:尾\s*[\])】》]?|[\])】》]?\s*)\s*开"
)
STRDECODE = r"""(?is)strdecode\s*\(\s*(["'])(.*?)\1\s*\)"""
DECODE_B64 = r"""(?is)decodeB64\s*\(\s*(["'])(.*?)\1\s*\)"""
PAGE_DATA = r"""(?is)__PAGE_DATA__\s*=\s*(["'])(.*?)\1"""
# Forms by which a value next to its label is proven.
STRICT = (
    ACTION + r"\s*(?:一个|一|①|1)?\s*尾\s*(?:[:：=＝◆◇〓\-—_~*#、，,.．。+＋!?！？]\s*)*[【\[(（〖《]?\s*(\d)(?!\d)(?!\s*(?:尾\s*)?(?:[、,，.．+＋/]\s*|\s+)\d)",
    ACTION + r"\s*(?:一个|一|①|1)?\s*(?:[:：=＝◆◇〓\-—_~*#、，,.．。+＋!?！？]\s*)*[【\[(（〖《]?\s*(\d)(?!\d)\s*[】\])）〗》]?\s*尾",
    r"杀\s*[【\[(（〖《]\s*(\d)(?!\d)\s*[】\])）〗》]\s*尾",
)
BRACKETED = (r"杀\s*[【\[(（〖《]\s*(\d{1,3})\s*[】\])）〗》]\s*尾", r"[【\[(（〖《]\s*杀\s*(\d{1,3})\s*尾\s*[】\])）〗》]")
LABEL = ACTION + r"\s*(?:一个|一|①|1)?\s*尾(?:\s*数)?|杀\s*尾\s*数"
LABEL_REACH = 120
FURTHER_VALUE = r"\s*(?:尾\s*)?(?:[、,，.．+＋/]\s*|\s+)\d(?:\s*尾)?"
FOREIGN = r"[㐀-鿿豈-﫿A-Za-z]"
ALLOWED_INFIX = r"杀|专区|本帖隐藏的内容"
WRITELN = r"""(?is)document\.writeln\s*\(\s*(["'])(.*?)\1\s*\)\s*;"""
PLACEHOLDER_BODIES = ("", "abcabc", "ok", "success")

FAILURE_WORDS = {  # in this order of precedence
    "missing": r"没有找到|缺少|不是指定|missing", "not a digit": r"非0-9尾", "tls": r"unexpected_eof|ssl|tls|handshake",
    "reset": r"winerror 10054|connection reset|remote host", "timeout": r"timed out|timeout", "http": r"http error|httperror",
}
TRANSPORT_WORDS = r"timeout|timed out|unexpected_eof|eof occurred|err_connection_closed|connection closed|connection reset|remote end closed|temporarily unavailable"
FINAL_WORDS = r"cert_authority_invalid|certificate verify failed|too_many_redirects"
FAILURE_CLASSES = {
    "missing": "没有数据", "not a digit": "非0-9尾", "tls": "TLS失败", "reset": "连接断开", "timeout": "超时", "http": "HTTP失败", "other": "抓取/解析失败",
}
DEFAULT_REASON = "本次未生成有效抓取结果"

WINDOW = 10
SUSPECT_RUN = 3
DUPLICATE_RUN = 6

# --- fixed values: end ---
