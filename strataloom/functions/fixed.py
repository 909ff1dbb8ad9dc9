"""Fixed values of the Vietnamese text rules: word lists, tables and patterns.

They define the results and are plain data; every function that uses one takes
another in its place.
"""

from __future__ import annotations

#: Old and new placement of tone marks, replaced one after the other in this order.
TONES = [
    ("oà", "òa"), ("oá", "óa"), ("oả", "ỏa"), ("oã", "õa"), ("oạ", "ọa"), ("Oà", "Òa"),
    ("Oá", "Óa"), ("Oả", "Ỏa"), ("Oã", "Õa"), ("Oạ", "Ọa"), ("oè", "òe"), ("oé", "óe"),
    ("oẻ", "ỏe"), ("oẽ", "õe"), ("oẹ", "ọe"), ("Oè", "Òe"), ("Oé", "Óe"), ("Oẻ", "Ỏe"),
    ("Oẽ", "Õe"), ("Oẹ", "Ọe"), ("uỳ", "ùy"), ("uý", "úy"), ("uỷ", "ủy"), ("uỹ", "ũy"),
    ("uỵ", "ụy"), ("Uỳ", "Ùy"), ("Uý", "Úy"), ("Uỷ", "Ủy"), ("Uỹ", "Ũy"), ("Uỵ", "Ụy"),
    ("quĩ", "quỹ"), ("quì", "quỳ"), ("quý", "quý"), ("kĩ", "kỹ"), ("mĩ", "mỹ"), ("Quĩ", "Quỹ"),
    ("Quì", "Quỳ"), ("Kĩ", "Kỹ"), ("Mĩ", "Mỹ"),
]

#: Characters replaced by one of ASCII, and characters removed.
TYPOGRAPHY_FROM, TYPOGRAPHY_TO = "\u00a0“”„«»‘’‚–—―", " \"\"\"\"\"'''---"
TYPOGRAPHY_REMOVED = "\u200b\ufeff\u200e\u200f"

#: Letters with Vietnamese diacritics.
DIACRITICS = (
    "áàảãạăắằẳẵặâấầẩẫậđéèẻẽẹêếềểễệíìỉĩịóòỏõọôốồổỗộơớờởỡợúùủũụưứừửữựýỳỷỹỵ"
    "ÁÀẢÃẠĂẮẰẲẴẶÂẤẦẨẪẬĐÉÈẺẼẸÊẾỀỂỄỆÍÌỈĨỊÓÒỎÕỌÔỐỒỔỖỘƠỚỜỞỠỢÚÙỦŨỤƯỨỪỬỮỰÝỲỶỸỴ"
)

#: A line in which one of these is found is boilerplate. Letter case does not matter, so none states that itself.
BOILERPLATE = (
    r"chia\s+sẻ\s+bài\s+viết\s*(qua)?\s*:?.*",
    r"chia\s+sẻ\s+lên\s+(facebook|zalo|twitter|linkedin).*",
    r"bình\s+luận\s*\(\d+\).*",
    r"gửi\s+ý\s+kiến\s+của\s+bạn.*",
    r"theo\s+dõi\s+chúng\s+tôi\s+trên.*",
    r"bản\s+quyền\s+(thuộc\s+về|©|\(c\)).*",
    r"mọi\s+hành\s+vi\s+sao\s+chép\s+phải\s+có\s+sự\s+đồng\s+ý.*",
    r"hotline\s*(hỗ\s+trợ|tư\s+vấn)?\s*:\s*[\d\s.-]+",
    r"đăng\s+ký\s+nhận\s+tin\s*(mới\s+nhất)?.*",
    r"chính\s+sách\s+bảo\s+mật\s*\|\s*điều\s+khoản\s+sử\s+dụng.*",
    r"bài\s+viết\s+liên\s+quan\s*:?.*",
    r"tin\s+cùng\s+chuyên\s+mục\s*:?.*",
    r"xem\s+thêm\s*:.*",
    r"\d{1,2}/\d{1,2}/\d{2,4},\s*\d{1,2}:\d{2}\s*(?:AM|PM)\s*about:\s*blank.*",
    r"about:\s*blank.*",
    r"\d{1,2}/\d{1,2}/\d{2,4},\s*\d{1,2}:\d{2}\s*(?:AM|PM)\s*.*(?:https?://|Nghị định|Thông tư|Luật).*",
    r"https?://(?:www\.)?luatvietnam\.vn/\S*",
    r"https?://(?:www\.)?thuvienphapluat\.vn/\S*",
    r"\bPhân tích Hiệu lực:\s*Đã biết\b",
    r"\bTình trạng hiệu lực:\s*Đã biết\b",
    r"\bPhân tích\s*(?:Phân tích)+\b",
)

#: What is cut out of a line, in this order; the second of each pair says whether letter case counts.
INLINE_NOISE = (
    (r"\d{1,2}/\d{1,2}/\d{2,4},\s*\d{1,2}:\d{2}\s*(?:AM|PM)\s*.*?(?:https?://\S+|Nghị định[^\n.]+)", True),
    (r"https?://(?:www\.)?luatvietnam\.vn/\S*", True),
    (r"https?://(?:www\.)?thuvienphapluat\.vn/\S*", True),
    (r"\bPhân tích(?:\s+Hiệu lực:\s*Đã biết|\s+Tình trạng hiệu lực:\s*Đã biết|\s+Phân tích)*\b", False),
)

#: Abbreviations after which a full stop ends no sentence, without it, as ``text.SENTENCE_END`` adds it; the second kind may be followed by several.
HONORIFICS = ["pgs", "gs", "ts", "ths", "bs", "cn", "mr", "ms", "mrs", "dr", "k/g", "đ/c"]
HONORIFICS_DOTTED = ["pgs.ts", "gs.ts", "th.s"]

#: Headings of laws, and lines of printed pages that are page numbers or print marks.
LEGAL_HEADING = r"^(Chương\s+[IVXLCDM\d]+.*|Điều\s+\d+.*|Mục\s+\d+.*)$"
PAGE_NUMBER = r"^(Trang\s+\d+(\s*/\s*\d+)?|Page\s+\d+(\s*of\s*\d+)?|-\s*\d+\s*-|\d+/\d+)$"
PRINT_MARK = r"\d{1,2}/\d{1,2}/\d{2,4},\s*\d{1,2}:\d{2}\s*(?:AM|PM)\s*about:\s*blank|about:\s*blank"
CHAPTER, ARTICLE = r"^Chương\s+[IVXLCDM\d]+[^\n]*$", r"^Điều\s+\d+\.[^\n]*$"

#: Titles of documents that are left out.
EXCLUDED_TITLES = ["nghi dinh 100 2019", "nghi dinh 123 2021", "nghi dinh 13 2023", "thong tu 43 2023", "thong tu 85 2014", "luat 36 2024 qh15", "nghi dinh 90 2023"]

#: Articles on driving, told by what follows their number; blanks stand for any white space (``classify._driving_rule``).
DRIVING_RULES = [
    "sử dụng đèn", "sử dụng tín hiệu còi", "nhường đường", "qua phà", "giao thông tại đường ngang", "giao thông trên đường cao tốc",
    "giao thông trong hầm", "xe ưu tiên", "trường hợp chở người trên thùng xe", "xe kéo xe", "quy tắc chung", "tín hiệu giao thông",
    "chấp hành hiệu lệnh", "vượt xe", "lùi xe", "tránh xe", "dừng xe, đỗ xe", "người đi bộ", "người khuyết tật", "người dẫn dắt súc vật",
    "giao thông trên cầu phao", "cấp cứu người bị tai nạn", "đào tạo lái xe", "sát hạch lái xe", "thanh tra giao thông",
    "xử phạt vi phạm hành chính", "tước quyền sử dụng giấy phép lái xe", "tạm giữ phương tiện", "nồng độ cồn",
]

#: The insurance decree, and the words that make a part of it relevant.
INSURANCE_TITLE = "nghi dinh 67 2023"
INSURANCE_WORDS = ["mức phí", "biểu phí", "xe ô tô", "xe chở người", "dưới 6 chỗ", "từ 6 đến 11 chỗ", "xe máy", "bồi thường", "bảo hiểm bắt buộc", "thời hạn bảo hiểm", "chứng nhận bảo hiểm", "trách nhiệm dân sự"]

#: Topics, in the order that breaks ties, and their keywords.
TOPICS: dict[str, list[str]] = {
    "bao_gia_chi_phi": ["giá xe", "giá niêm yết", "giá bán", "lăn bánh", "chi phí lăn bánh", "lệ phí trước bạ", "trước bạ", "biển số", "phí cấp biển", "phí đăng ký", "bảng giá", "chi phí", "triệu đồng", "tỷ đồng", "dự toán chi phí", "phí bảo trì đường bộ", "đăng kiểm", "miễn trước bạ"],
    "chinh_sach_uu_dai": ["ưu đãi", "khuyến mại", "chiết khấu", "giảm giá", "voucher", "thu cũ đổi mới", "chuyển đổi xanh", "mua 1 tặng 1", "quà tặng", "tri ân", "kích cầu", "hỗ trợ", "chương trình đặc biệt", "hạn chót"],
    "tai_chinh_tra_gop": ["trả góp", "vay mua xe", "vay ngân hàng", "lãi suất", "thời hạn vay", "hạn mức vay", "tỷ lệ vay", "hồ sơ vay", "chứng minh thu nhập", "thế chấp", "đặt cọc", "hủy cọc", "rút cọc", "hợp đồng mua bán", "thanh toán", "hóa đơn"],
    "pin_va_tram_sac": ["thuê pin", "mua pin", "kèm pin", "gói thuê pin", "cọc pin", "trạm sạc", "trụ sạc", "sạc pin", "chi phí sạc", "sạc tại nhà", "sạc nhanh", "dung lượng pin", "kwh", "quãng đường", "bảo hành pin"],
    "thong_so_va_chon_xe": ["phiên bản", "bản eco", "bản plus", "bản base", "thông số kỹ thuật", "kích thước", "chiều dài", "chiều rộng", "công suất", "mã lực", "mô-men xoắn", "túi khí", "adas", "nội thất", "ngoại thất", "chọn xe", "so sánh xe", "đánh giá xe", "trải nghiệm lái", "cảm giác lái", "suv"],
    "thu_tuc_phap_ly_so_huu": ["đăng ký xe", "cấp biển số", "biển số định danh", "thu hồi biển số", "sang tên", "thủ tục mua xe", "kiểm định an toàn", "chu kỳ kiểm định", "bảo hiểm bắt buộc", "bảo hiểm thân vỏ", "bảo hiểm tnds"],
    "bao_hanh_hau_mai": ["bảo hành", "bảo dưỡng", "thời hạn bảo hành", "hậu mãi", "cứu hộ 24/7", "mobile service", "xưởng dịch vụ", "phụ tùng", "sửa chữa lưu động"],
}

#: Categories always admitted, the topic of a category without hits, and title words of documents kept.
CORE_CATEGORIES = ["chinh_sach_uu_dai", "gia_xe_va_chi_phi_lan_banh", "thong_so_ky_thuat", "faq", "trai_nghiem_danh_gia", "tai_chinh_tra_gop"]
DEFAULT_TOPICS = {
    "chinh_sach_uu_dai": "chinh_sach_uu_dai", "gia_xe_va_chi_phi_lan_banh": "bao_gia_chi_phi", "thong_so_ky_thuat": "thong_so_va_chon_xe",
    "trai_nghiem_danh_gia": "thong_so_va_chon_xe", "tai_chinh_tra_gop": "tai_chinh_tra_gop", "faq": "thong_so_va_chon_xe", "thu_tuc_phap_ly": "thu_tuc_phap_ly_so_huu",
}
FALLBACK_TOPIC, LEGAL_TOPIC = "thong_so_va_chon_xe", "thu_tuc_phap_ly_so_huu"
LEGAL_TITLE_WORDS = ["lệ phí trước bạ", "cho vay", "biển số", "kiểm định", "bảo hiểm bắt buộc"]

#: The reasons that classification gives.
REASONS = {
    "excluded": "Excluded legal document: ", "driving": "Irrelevant traffic driving rule or penalty", "insurance": "Insurance enterprise bureaucracy (non-vehicle buyer relevance)",
    "noise": "Empty browser print noise", "core": "Core consultation category", "topic": "Vehicle purchasing & ownership legality", "none": "No car purchasing or consultation relevance",
    "legal_document": "Car purchasing & ownership legality document", "other_document": "Non-automotive general regulation",
}

#: Fees in VND, provinces of the cost matrix with their plate fees, and rules as (code, name, amount, description).
INSPECTION_FEE, ROAD_FEE, INSURANCE_FEE = 340_000, 1_560_000, 480_700
KEY_PROVINCES = [("01", "Hà Nội", 20_000_000), ("79", "TP. Hồ Chí Minh", 20_000_000), ("48", "Đà Nẵng", 1_000_000), ("31", "Hải Phòng", 1_000_000), ("92", "Cần Thơ", 1_000_000), ("other", "Các tỉnh thành khác (Khu vực II, III)", 1_000_000)]
FEE_RULES = [
    ("REGISTRATION_FEE", "Lệ phí trước bạ ô tô điện", 0, "Nghị định 10/2022/NĐ-CP & 50/2025/NĐ-CP: Ô tô điện chạy pin miễn 100% lệ phí trước bạ"),
    ("PLATE_FEE_HN_HCM", "Phí cấp biển số Khu vực I (Hà Nội, TP.HCM)", 20_000_000, "Thông tư 60/2023/TT-BTC: Hà Nội và TP.HCM áp dụng 20.000.000 VNĐ"),
    ("PLATE_FEE_OTHER", "Phí cấp biển số Khu vực II & III (Tỉnh/Thành khác)", 1_000_000, "Thông tư 60/2023/TT-BTC: Các tỉnh thành còn lại 1.000.000 VNĐ"),
    ("INSPECTION_FEE", "Phí kiểm định đăng kiểm", INSPECTION_FEE, "Thông tư 55/2022/TT-BTC: Xe con dưới 10 chỗ"),
    ("ROAD_MAINTENANCE_FEE", "Phí bảo trì đường bộ (1 năm)", ROAD_FEE, "Nghị định 90/2023/NĐ-CP: Xe cá nhân 130.000 VNĐ/tháng"),
    ("MANDATORY_INSURANCE", "Bảo hiểm TNDS bắt buộc (1 năm)", INSURANCE_FEE, "Nghị định 67/2023/NĐ-CP: Xe dưới 6 chỗ không kinh doanh vận tải"),
]

#: Words of two-wheelers and parts of addresses that an address list leaves out, and of promotion links.
TWO_WHEELERS = ["xe-may", "xe máy", "xmd", "xe dap", "xe-dap", "xedap", "ebike", "e-scooter", "xe hai banh", "xe 2 banh", "scooter"]
LAW_PORTALS, LAW_PATHS = ["luatvietnam.vn", "thuvienphapluat.vn"], ["/luat-", "nghi-dinh", "thong-tu", "van-ban-luat"]
PRICE_CATEGORY, SPEC_CATEGORY = "gia_ca_lan_banh", "thong_so_ky_thuat"
PROMOTION_PARTS = ["uu-dai", "khuyen-mai", "chuong-trinh", "vi-tuong-lai-xanh"]
