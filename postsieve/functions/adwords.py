"""Fixed values of the ad rules. They decide labels, so they are data and not to be tidied."""

# Tags that mark paid posts.
AD_TAGS = [
    "#광고", "#유료광고", "#협찬", "#무료협찬", "#제품협찬", "#체험단",
    "#원고료", "#원고지원", "#제품제공", "#제공받음", "#제공받아",
    "#서포터즈", "#앰버서더", "#브랜드앰버서더", "#브랜디드콘텐츠", "#제작지원",
    "#후원", "#홍보", "#공구", "#공동구매",
    "#PPL", "#ppl", "#sponsored", "#ad", "#AD", "#paidpartnership",
]

# Korean key phrases; letters of a part may be set apart, parts may be set apart by blanks.
KEY_PHRASES = [
    ["유료", "광고"], ["광고"], ["협찬"], ["제품", "제공"], ["제공받"], ["무상", "제공"], ["원고", "료"],
    ["제작", "지원"], ["서포터즈"], ["앰버서더"], ["브랜드", "앰버서더"], ["브랜디드", "콘텐츠"],
    ["제휴"], ["콜라보"], ["위탁"], ["대행"], ["공동", "구매"], ["공구"],
]

# What may stand between two letters of a phrase.
LETTER_GAP = r"[ \t\n\r._\-·]{0,2}"

# English key phrases, whole words; the parts of a phrase may be set apart by blanks.
KEY_WORDS = [
    ["paid", "partnership"], ["sponsored"], ["sponsorship"], ["gifted"], ["PR"], ["PPL"], ["AD"],
    ["repost"], ["regram"],
]

# Plain substrings, used only when no key phrase is found.
SIMPLE_WORDS = [
    "부업", "광고", "협찬", "재테크", "출금", "공짜", "수익", "카톡", "원금", "댓글",
    "할인", "이벤트", "부자", "repost", "regram", "구매", "문의전화", "오시는",
    "구매링크", "예약문의", "상담문의", "문의주세요", "디엠주세요", "dm주세요",
    "링크클릭", "프로필 링크", "공구", "공동구매", "먹킷리스트", "먹킷",
]

# Calls to act.
CTA_WORDS = [
    "예약", "문의", "상담", "상담문의", "예약문의", "문의주세요", "주문", "구매",
    "구매링크", "링크", "프로필 링크", "링크클릭", "dm", "디엠", "카톡", "카카오톡", "톡주세요", "카톡주세요",
]

# Link starts and hosts, found anywhere in the text.
LINKS = [
    "http://", "https://", "linktr.ee", "smartstore", "smartstore.naver.com", "shopping.naver.com", "naver.me",
    "coupa.ng", "forms.gle", "forms.office.com", "tally.so", "instabio", "link.inbio", "linkin.bio",
    "pf.kakao.com", "open.kakao.com", "page.stibee.com", "link.inpock", "urlr.me", "kko.to",
    "bit.ly", "t.co", "goo.gl", "notion.site", "instagram.com/p/", "youtu.be", "youtube.com",
]

# Korean mobile number.
PHONE_BODY = r"01[016789][-\s.]?\d{3,4}[-\s.]?\d{4}"

# Points per signal.
POINTS = {"hash": 70, "kw": 30, "kw_simple": 20, "cta": 10, "link": 15, "phone": 10}

# Words the label check hides from its model.
MASK_AD_WORDS = [
    "광고", "유료광고", "협찬", "제품제공", "제공받", "원고료", "서포터즈", "앰배서더", "sponsored",
    "paid partnership", "gifted", "AD", "PPL", "PR",
]
MASK_CTA_WORDS = [
    "예약", "문의", "상담", "구매", "구매링크", "디엠", "DM", "카톡", "카카오톡", "전화", "프로필 링크", "링크",
]
MASK_LINKS = [r"https?://\S+", r"linktr\.ee", "smartstore", r"naver\.me", r"bit\.ly", r"pf\.kakao\.com"]
