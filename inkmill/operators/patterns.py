"""Patterns and word lists that results depend on, in Java's spelling. Fixed values."""

from __future__ import annotations

from inkmill.functions.text import SPACE

# Headings.
CHAPTER_WORDS = "chương|chuong|phần|phan|mục|muc|bài|bai|thi|chuyện|chuyen|chapter|part|book|cuốn|cuon"
CHAPTER = rf"(?iu)^[{SPACE}]*(?:{CHAPTER_WORDS})[{SPACE}]*(?:[0-9]+|[ivxlcdm]+|[a-z])(?![\p{{L}}\p{{N}}_])[^\n]*$"
BARE_NUMBER = rf"(?iu)^[{SPACE}]*(?:[0-9]{{1,3}}|[ivxlcdm]{{1,7}})[.):]?[{SPACE}]*$"
WIKI_HEADING = rf"^[{SPACE}]*(={{2,6}})[{SPACE}]*(.*?[^{SPACE}])[{SPACE}]*\1[{SPACE}]*$"
MARKDOWN_HEADING = rf"^(#{{1,6}})[{SPACE}]+(.*[^{SPACE}])[{SPACE}]*#*[{SPACE}]*$"
UNDERLINE = rf"^([=\-~*_#])\1{{2,}}[{SPACE}]*$"
NON_CHAPTER = (
    "mục lục|mụclục|nội dung|table of contents|contents|toc|danh mục|"
    "liên kết ngoài|liên kết|tham khảo|nguồn|ghi chú|ghi chú bản dịch|chú thích|"
    "chú thích sách|bản quyền|giấy phép|license|licence|"
    "tác giả|soạn giả|người dịch|ban dịch|bản dịch|translator|translator[s]?|"
    "xem thêm|see also|liên quan|bibliography|thư mục|"
    "phụ lục|phụlục|appendix|phần đầu|phần cuối|"
    "lời giới thiệu|lời nói đầu|lời ngỏ|lời cảm ơn"
)
APPARATUS = (
    "mục lục|nội dung|table of contents|contents|toc|liên kết ngoài|"
    "tham khảo|nguồn|ghi chú|chú thích|bản quyền|giấy phép|license|tác giả|"
    "soạn giả|người dịch|ban dịch|bản dịch|translator|xem thêm|bibliography|"
    "thư mục|phụ lục|chú thích sách|editor|source"
)
PLACEHOLDERS = ["Nội dung", "Phần mở đầu", "Nội Dung"]
WHOLE_TITLE, PREAMBLE_TITLE, DEFAULT_TITLE = "Nội dung", "Phần mở đầu", "Chương"

# Lines that are no prose.
PAGE_NUMBER = rf"(?iu)^[{SPACE}]*(?:trang[{SPACE}]+|page[{SPACE}]+)?[-–—]?[{SPACE}]*\d{{1,4}}[{SPACE}]*[-–—]?[{SPACE}]*$"
SCRIPT_PAGE_NUMBER = rf"(?iu)^[{SPACE}]*(?:trang[{SPACE}]+|page[{SPACE}]+|tr\.?)?[-–—]?[{SPACE}]*\d{{1,4}}[{SPACE}]*[-–—]?[{SPACE}]*$"
PARSER_REPORT = (
    rf"(?iu)^[{SPACE}]*(?:NewPP limit report|Transclusion expansion time report|(?:CPU|Real|Lua) time usage|Lua memory usage|"
    r"Preprocessor visited node count|Revision size|Post[-‐‑]expand include size|Template argument size|"
    r"Highest expansion depth|Expensive parser function count|Unstrip(?:led)?(?: recursion depth| post[-‐‑]expand size)|"
    r"Number of Wikibase entities loaded|Cached time|Cache expiry|Reduced expiry|Complications|eqiad|"
    r"main[-‐‑][0-9a-f]{6,}|[-‐‑]?total(?![\p{L}\p{N}_]))"
)
LONE_ARROW = rf"^[{SPACE}]*[←→↑↓⇐⇒‹›«»]+[{SPACE}]*$"
PRINTED_NUMBER = rf"^[{SPACE}]*[\d$.,ivxlIVXL]{{1,8}}[{SPACE}]*$"
HAN_ONLY = rf"^[{SPACE}\u3000-\u9fff\u8c48-\ufaff\uff00-\uffef]+$"
RULE = rf"^[{SPACE}*_\-=~·—–─═\ufffd]{{3,}}$"
#: No letter, digit or underscore follows.
_END = r"(?![\p{L}\p{N}_])"
TITLE_PAGE = (
    rf"(?iu)^[{SPACE}]*(?:"
    rf"(?:\d+[{SPACE}]*'[{SPACE}]*|\d+[{SPACE}]*(?:e|ème|eme)[{SPACE}]*)?édition{_END}"
    rf"|(?:première|premiere)[{SPACE}]+(?:fois|édition|edition)"
    r"|transcrit[\p{L}\p{N}_]*"
    rf"|avec[{SPACE}]+des[{SPACE}]+notes{_END}"
    rf"|des[{SPACE}]+notes[{SPACE}]+explicatives{_END}"
    rf"|(?:illustrations?|figures?|gravures?)[{SPACE}]+(?:de|du|par){_END}"
    rf"|prix{_END}|exemplaires?{_END}|tirage{_END}|catalogue{_END}"
    rf"|revu{_END}|corrigé{_END}|corrige{_END}|augmenté{_END}|augmente{_END}"
    rf"|imprimerie{_END}|librairie{_END}|presses{_END}|éditeur{_END}|editeur{_END}"
    rf"|poème{_END}|poeme{_END}"
    rf"|tous[{SPACE}]+droits[{SPACE}]+réservés"
    rf"|(?:zh|ja|ko|en|fr|ru):[^{SPACE}]+"
    r")"
)
FURNITURE = [PARSER_REPORT, LONE_ARROW, PRINTED_NUMBER, HAN_ONLY, RULE, TITLE_PAGE]
RUNNING_HEAD_CHARS, RUNNING_HEAD_WORDS, RUNNING_HEAD_REPEATS = 80, 8, 5
RUNNING_HEAD_ENDS = r"""[.!?…,:;"'”’»)\]}]$"""
PDF_JUNK = r"(?iu)^(?:đ[èe]o trang[ \t]+\d+|trang[ \t]+\d+|\d+)$"

# Markup.
FORBIDDEN = (
    r"(?m)(?:<[a-zA-Z/!][^>]*>|!\[[^\]]*\]\([^)]*\)|\[[^\]]*\]\([^)]*\)|^\s*\|.*\|\s*$|\[\^[^\]]+\]|\{\{.*?\}\}|\[\[.*?\]\]"
    r"|[*_]{1,3}[^*_]+[*_]{1,3}|<ref.*?>|</ref>)"
)
GUTENBERG_START = r"(?iu)\*\*\*\s*START OF (?:THE|THIS) PROJECT GUTENBERG[^*]*\*\*\*"
GUTENBERG_END = r"(?iu)\*\*\*\s*END OF (?:THE|THIS) PROJECT GUTENBERG"
CREDITS = "produced by|release date|encoding|audio:|language:|credits:"

# Words that one edition prints without the space between their parts, in the order they are repaired.
GLUED = {
    "Túykiều": "Túy Kiều", "Túyvân": "Túy Vân", "Túyvăn": "Túy Vân", "TúyVân": "Túy Vân", "TúyKiều": "Túy Kiều",
    "TúyKièu": "Túy Kiều", "TúyKiểu": "Túy Kiều", "Vươngquan": "Vương Quan", "VươngQuan": "Vương Quan",
    "Đạmtiên": "Đạm Tiên", "ĐạmTiên": "Đạm Tiên", "Kimtrọng": "Kim Trọng", "KimTrọng": "Kim Trọng",
    "Quốcngữ": "Quốc ngữ", "QuốcNgữ": "Quốc ngữ", "NguyễnDu": "Nguyễn Du", "TrươngVĩnh": "Trương Vĩnh",
    "GiaTĩnh": "Gia-tịnh", "TÚYKIỀU": "Túy Kiều", "TÚYVÂN": "Túy Vân", "KIMTRỌNG": "Kim Trọng", "KIMTRONG": "Kim Trọng",
    "TÍCHTÚYKIỀU": "Tích Túy Kiều", "TÍCHTÚYKIÊU": "Tích Túy Kiều", "ĐẠMTIÊN": "Đạm Tiên", "HOẠNTHƠ": "Hoạn Thơ",
    "BẠCHẠNH": "Bạch Ánh", "BẠCBÀ": "Bạc Bà", "THỌGIÁM": "Thọ Giám", "TỪHẢI": "Từ Hải", "QUIVÕTÍCH": "Qui Võt Ích",
    "SỞKHANH": "Sở Khanh", "TÁCTHOẠNÔ": "Tác Thơ Ôn", "nởnang": "nở nang", "khônngoan": "khôn ngoan",
    "phớtphớt": "phớt phớt", "đuộtduột": "đuột duột", "lảothông": "lảo thông", "vănchương": "văn chương",
    "kinhsử": "kinh sử", "nguyệtthu": "nguyệt thu", "thanhthu": "thanh thu", "đầuđuối": "đầu đuối", "tâmhồn": "tâm hồn",
    "tuổitạc": "tuổi tạc", "đoạntrường": "đoạn trường", "phongtrần": "phong trần", "thânphận": "thân phận",
    "mặttrời": "mặt trời", "thiênhương": "thiên hương", "thươngtâm": "thương tâm", "lầuxanh": "lầu xanh",
    "thiênđàng": "thiên đàng", "nướcnon": "nước non", "bạcphận": "bạc phận", "thanhlâu": "thanh lâu",
    "ngọcđàng": "ngọc đàng", "thiêntài": "thiên tài", "tàitình": "tài tình", "đồngthân": "đồng thân",
    "thươnggia": "thương gia", "quângia": "quân gia", "hàngđầu": "hàng đầu", "ngàyngày": "ngày ngày",
    "trướcmai": "trước mai", "nướcmặt": "nước mặt", "xuânxanh": "xuân xanh", "thanhthanh": "thanh thanh",
    "songsong": "sọng sọng", "xanhxanh": "xanh xanh", "lònglòng": "lòng lòng", "ngườingười": "người người",
    "đườngđường": "đường đường", "thôithôi": "thôi thôi", "Thúcsanh": "Thúc sanh", "ThúcSanh": "Thúc sanh",
    "THÚCSANH": "Thúc sanh", "Mãgiámsanh": "Mã giám sanh", "MÃGIÁMSANH": "Mã giám sanh", "GIÁMSANH": "giám sanh",
    "Túbà": "Tú Bà", "TÚBÀ": "Tú Bà", "VƯƠNGQUAN": "Vương Quan", "Trạctuyền": "Trạc tuyền", "TRẠCTUYỀN": "Trạc tuyền",
    "Liêudương": "Liêu Dương", "LIỀDƯƠNG": "Liêu Dương", "Sởkhanh": "Sở Khanh", "hôitanh": "hôi tanh",
    "hôiTanh": "hôi tanh", "hôiTanH": "hôi tanh", "tròntrặn": "tròn trặn", "trònTrặn": "tròn trặn", "dồidào": "dồi dào",
    "dồiDào": "dồi dào", "bâygiờ": "bây giờ", "bâyGiờ": "bây giờ", "ngạnchung": "ngạn chung", "ThanhLâu": "Thanh Lâu",
    "THANHLÂU": "Thanh Lâu", "ChânThiện": "Chân Thiện", "ChâuThoa": "Châu Thoa", "thangđinh": "thang đinh",
}
