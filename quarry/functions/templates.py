"""Message wordings, summaries and surface variation for the generator.

A wording is assembled: a situation (what the customer is writing about, what
happened, what they want, and how that is labelled) is spoken in a register.
Every pool has registers and situations of its own, so the pools are disjoint.
Situations that name no order give messages without an order id.
"""

from __future__ import annotations

# (issue, subject, event, wish, sentiment, priority)
_SITUATIONS = {
    "base": [
        ("delivery_delay", "the garden chairs on order {oid}", "were due before our party on Saturday and the courier page is empty", "I need a firm date today", "negative", "high"),
        ("delivery_delay", "the pre-sale book, order {oid}", "has a new dispatch date every morning", "which one should I believe", "neutral", "medium"),
        ("delivery_delay", "the second half of order {oid}", "is still at your depot", "there is no rush, send it with the next run", "positive", "low"),
        ("delivery_delay", "a birthday parcel, order {oid}", "went back to the sender after one attempt", "have it brought again this week", "negative", "medium"),
        ("damaged_item", "the fish tank on order {oid}", "leaks along one seam and has soaked the floor", "somebody must collect it now", "negative", "high"),
        ("damaged_item", "one jar of order {oid}", "had a loose lid, the others are fine", "a small credit would do", "positive", "low"),
        ("damaged_item", "the tablet on order {oid}", "shows a dead line across its screen", "tell me how the warranty works", "neutral", "medium"),
        ("wrong_item", "the cat food on order {oid}", "turned out to be for dogs", "let me know which label to use for the return", "neutral", "low"),
        ("wrong_item", "the medicine box on order {oid}", "is made out to a stranger", "this must be put right at once", "negative", "high"),
        ("billing_error", "the voucher for order {oid}", "was accepted and then not taken off", "take it off the total", "negative", "medium"),
        ("billing_error", "the tax line of order {oid}", "uses the rate of another country", "I would need a corrected bill for my books", "neutral", "low"),
        ("billing_error", "my monthly plan, order {oid}", "was renewed after I had ended it", "stop it and return the fee", "negative", "high"),
        ("refund_request", "the concert seats on order {oid}", "are of no use since the show was called off", "return the money to my card", "neutral", "medium"),
        ("refund_request", "the curtains from order {oid}", "reached your returns desk a month ago", "I have asked four times for my money", "negative", "high"),
        ("account_access", "my profile", "is tied to a phone that I lost abroad", "help me in another way", "negative", "high"),
        ("account_access", "the app", "asks for a code and then accepts it on the second try", "no hurry", "neutral", "low"),
        ("account_access", "our shared login", "was closed when a colleague left", "please open it for the team", "neutral", "medium"),
        ("other", "your repair evening", "was a delight", "do hold another one", "positive", "low"),
        ("other", "the wool of the grey scarf", "is not described anywhere", "where does it come from", "neutral", "low"),
        ("other", "a school like ours", "would take forty copies", "whom do I ask for an offer", "positive", "medium"),
    ],
    "diverse": [
        ("delivery_delay", "freight booking {oid}", "missed its 06:30 slot at gate 12", "advise the new slot", "neutral", "medium"),
        ("delivery_delay", "my bike, {oid}", "has circled the city for 16 days", "bring it or forget it", "negative", "high"),
        ("damaged_item", "pallet {oid}", "was unloaded with 7 of 20 sacks torn", "confirm a replacement", "negative", "medium"),
        ("damaged_item", "that vase from {oid}", "lost its handle somewhere on the road", "any spare part", "neutral", "low"),
        ("wrong_item", "kit {oid}", "has 8 mm bolts in place of 6 mm", "swap the bag only", "neutral", "low"),
        ("wrong_item", "our catering order {oid}", "came without the vegan trays, 3 hours before the event", "send them by taxi", "negative", "high"),
        ("billing_error", "statement {oid}", "lists a deposit of 250 that we never agreed", "strike it out", "negative", "high"),
        ("billing_error", "the exchange rate on {oid}", "is 4 days old", "recalculate it when you can", "neutral", "low"),
        ("refund_request", "the course fee, {oid}", "covers a term that I will spend in hospital", "can half of it come back", "neutral", "medium"),
        ("refund_request", "ticket {oid}", "was for a train that never left", "pay it out within 7 days", "negative", "medium"),
        ("account_access", "the admin seat", "moved to an address from 2009", "move it back", "neutral", "medium"),
        ("account_access", "my kid's profile", "locked all 4 of us out", "we want in tonight", "negative", "high"),
        ("other", "your newsletter", "made the whole office laugh on the 1st", "keep going", "positive", "low"),
        ("other", "the loyalty points", "could be shared by 2 people", "just an idea", "positive", "low"),
    ],
    "ood": [
        ("delivery_delay", "seedlings, ref {oid}", "9 days on the road, surely wilted by now", "replacement expected", "negative", "high"),
        ("delivery_delay", "ref {oid}", "customs form returned for signature", "awaiting word", "neutral", "medium"),
        ("damaged_item", "mirror, ref {oid}", "2 corners gone", "photo attached", "negative", "medium"),
        ("wrong_item", "ref {oid}", "left shoe twice", "one right shoe needed", "neutral", "medium"),
        ("wrong_item", "spare filter, ref {oid}", "fits the older model only", "exchange", "neutral", "low"),
        ("billing_error", "ref {oid}", "school discount of 15% missing", "reissue", "negative", "medium"),
        ("refund_request", "cottage booking, ref {oid}", "road washed away", "full amount back", "neutral", "high"),
        ("account_access", "operator console", "token expired at 02:10", "renew tonight", "negative", "high"),
        ("other", "volunteer day", "6 of us would like to join", "tell us when", "positive", "low"),
    ],
}

# How a pool speaks: patterns over the capitalised or plain parts of a situation.
_REGISTERS = {
    "base": ["{Subject} {event}. {Wish}."],
    "diverse": ["{subject} {event}... {wish} ok??", "To whom it may concern: {subject} {event}. Our request: {wish}."],
    "ood": ["* {subject} -- {event} -- {wish}"],
}


def _spoken(pattern: str, subject: str, event: str, wish: str) -> str:
    parts = {"{subject}": subject, "{event}": event, "{wish}": wish, "{Subject}": subject[0].upper() + subject[1:], "{Wish}": wish[0].upper() + wish[1:]}
    for slot, text in parts.items():
        pattern = pattern.replace(slot, text)
    return pattern


# (pool, issue, template, sentiment, priority); template_idx is the position
# within (pool, issue).
TEMPLATE_ROWS = [
    (pool, issue, _spoken(pattern, subject, event, wish), sentiment, priority)
    for pool, situations in _SITUATIONS.items()
    for pattern in _REGISTERS[pool]
    for issue, subject, event, wish, sentiment, priority in situations
]

# What each issue is about; a summary names it, the detailed form with the id.
_TOPICS = {
    "delivery_delay": "Goods not there in time",
    "damaged_item": "Goods broken or faulty",
    "wrong_item": "Goods other than chosen",
    "billing_error": "Amount billed in dispute",
    "refund_request": "Money back asked for",
    "account_access": "Sign-in trouble",
    "other": "Remark or enquiry",
}
_WITH_ORDER = ("delivery_delay", "damaged_item", "wrong_item", "billing_error", "refund_request")
SUMMARIES = {issue: f"{topic}." for issue, topic in _TOPICS.items()}
DETAILED_SUMMARIES = {issue: f"{topic}" + (" (order {oid})." if issue in _WITH_ORDER else ".") for issue, topic in _TOPICS.items()}

# Surface variation, one empty choice on each axis.
GREETINGS = ["", "To the service desk: ", "Morning all, ", "Quick note: ", "Greetings, ", "A question from a customer: "]
CLOSINGS = ["", " Regards from a regular.", " Awaiting your reply.", " All the best.", " Sent from the train.", " Call me if unclear."]

# Fixed value: the text that replaces an absent order id, and the patterns it
# replaces, tried in this order.
NO_ID_TEXT = "my order"
NO_ID_PATTERNS = ["order {oid}", "#{oid}", "{oid}"]

POOLS = ("base", "diverse", "ood")


def pool_rows(pools: tuple[str, ...]) -> list[tuple]:
    """Rows of the combined pool, issue-major: for each issue, the templates of
    each pool in ``pools`` order, so template_idx is uniform over the union."""
    from quarry.contract import ISSUES

    out = []
    for issue in ISSUES:
        idx = 0
        for p in pools:
            for pool, iss, tpl, sent, prio in TEMPLATE_ROWS:
                if pool == p and iss == issue:
                    out.append((p, issue, idx, tpl, sent, prio))
                    idx += 1
    return out
