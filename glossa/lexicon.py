"""Word lists of the citation domain, and the parameters that extend them."""

from __future__ import annotations

from dataclasses import dataclass, field


def _listed(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(x.strip() for x in text.replace("\n", " ").split(";") if x.strip()))


def _paired(text: str) -> dict[str, str | None]:
    rows = (line.partition(" | ") for line in text.strip().splitlines())
    return {k.strip(): v.strip() or None for k, _, v in rows}


# Results depend on these words and names.

#: Periodicals, lower-cased.
PERIODICALS = _listed("""
annals of iowa; associated press; atlantic; atlantic monthly; bbc news; brigham young university speeches;
byu devotional; byu speeches; byu studies; byu studies quarterly; chicago tribune; children's friend;
christian science monitor; christianity today; church history; church news; church news and events; church section; cnn;
conference report; contributor; daily telegraph; deseret evening news; deseret news; deseret news church news;
deseret news church section; deseret weekly; dialogue; elders' journal; elders’ journal; ensign; ensign or liahona;
evening and morning star; first things; forbes; fortune; friend; guardian; harper's; harper's magazine;
harvard business review; imprimis; improvement era; instructor; jama; journal of discourses;
journal of the american medical association; juvenile instructor; ladies' home journal;
latter day saints' messenger and advocate; latter-day saint millennial star; liahona; liahona or ensign; life;
london times; look; los angeles times; meridian magazine; messenger and advocate; millennial star; national geographic;
nature; new era; new york times; new york times magazine; new yorker; newsroom; newsweek; npr; psychology today;
reader's digest; readers digest; reader’s digest; relief society bulletin; relief society magazine; religious educator;
reuters; salt lake daily herald; salt lake herald; salt lake tribune; saturday evening post; science;
scientific american; speeches; sunstone; tambuli; the annals of iowa; the atlantic; the children's friend;
the christian science monitor; the contributor; the economist; the evening and the morning star; the friend;
the guardian; the instructor; the lancet; the new york times; the new yorker; the religious educator;
the saturday evening post; the times; the wall street journal; the washington post; the week; time; times and seasons;
u.s. news & world report; usa today; wall street journal; washington post; woman's exponent; young woman's journal
""")
#: Hymnals, lower-cased.
HYMNALS = _listed("""
children's songbook; children’s songbook; deseret sunday school songs; hymns; hymns for home and church;
hymns of the church of jesus christ of latter-day saints; latter-day saint hymns; sacred hymns and spiritual songs
""")
#: Parts of titles of manuals.
MANUALS = _listed("""
teachings of presidents of the church; general handbook; handbook; preach my gospel; gospel principles;
true to the faith; for the strength of youth; come, follow me; doctrines of the gospel; gospel topics;
guide to the scriptures; bible dictionary; topical guide; student manual; institute; seminary; melchizedek priesthood;
relief society; primary; sunday school; young women; young men; aaronic priesthood; lesson manual
""")
#: Serials cited by volume and page: containers, not works.
SERIALS = _listed("""
church history in the fulness of times; conference report; dhc; documentary history of the church;
encyclopedia of mormonism; hc; history of the church; joseph smith papers; journal of discourses; messenger and advocate;
millennial star; the joseph smith papers; times and seasons
""")
#: Compilations and works whose words belong to one person: person | works.
_IMPLIED = """
Joseph Smith | teachings of the prophet joseph smith; words of joseph smith; the words of joseph smith; the personal writings of joseph smith; personal writings of joseph smith; lectures on faith
Brigham Young | discourses of brigham young
Joseph F. Smith | gospel doctrine
Joseph Fielding Smith | doctrines of salvation; answers to gospel questions
David O. McKay | gospel ideals
Spencer W. Kimball | the miracle of forgiveness; faith precedes the miracle; the teachings of spencer w. kimball
Ezra Taft Benson | teachings of ezra taft benson; the teachings of ezra taft benson
Gordon B. Hinckley | teachings of gordon b. hinckley
Harold B. Lee | the teachings of harold b. lee
Lorenzo Snow | the teachings of lorenzo snow
George Albert Smith | the teachings of george albert smith
C. S. Lewis | mere christianity; the screwtape letters; the weight of glory; the great divorce; the problem of pain; the four loves; surprised by joy; a grief observed; the abolition of man; the chronicles of narnia; the lion, the witch and the wardrobe; the lion, the witch, and the wardrobe; the magician's nephew; the magician’s nephew; the last battle; the silver chair; prince caspian; the voyage of the dawn treader; the horse and his boy
John Bunyan | the pilgrim's progress; the pilgrim’s progress
John Milton | paradise lost
Dante Alighieri | the divine comedy; inferno; paradiso; purgatorio
Victor Hugo | les misérables; les miserables
Charles Dickens | a christmas carol; a tale of two cities; great expectations; david copperfield; oliver twist
Thomas à Kempis | the imitation of christ
Viktor E. Frankl | man's search for meaning; man’s search for meaning
Antoine de Saint-Exupéry | the little prince
(nobody) | the book of mormon; the holy bible
William Shakespeare | hamlet; macbeth; king lear; othello; the tempest; julius caesar; romeo and juliet; the merchant of venice; as you like it; measure for measure; henry v; henry the fifth; king henry v; the life of king henry v; richard iii; richard the third; henry viii; king henry viii; the two gentlemen of verona; two gentlemen of verona; much ado about nothing; twelfth night; a midsummer night's dream; a midsummer night’s dream; the taming of the shrew; coriolanus; antony and cleopatra; troilus and cressida; timon of athens; cymbeline; the winter's tale; the winter’s tale; richard ii; henry iv; henry iv, part 1; henry iv, part 2; henry vi; king john; love's labour's lost; love’s labour’s lost; the comedy of errors; titus andronicus; pericles; all's well that ends well; all’s well that ends well; the merry wives of windsor; the rape of lucrece; sonnets; shakespeare's sonnets; shakespeare’s sonnets; the tragedy of hamlet; the tragedy of macbeth; the tragedy of king lear; the tragedy of julius caesar; the tragedy of romeo and juliet; the complete works of william shakespeare; the complete works of shakespeare
Homer | the odyssey; the iliad
Virgil | the aeneid
Plato | the republic
Fyodor Dostoevsky | the brothers karamazov; crime and punishment
Leo Tolstoy | war and peace; anna karenina
J. R. R. Tolkien | the lord of the rings; the hobbit; the fellowship of the ring; the two towers; the return of the king
Henry David Thoreau | walden
Ralph Waldo Emerson | self-reliance
Walt Whitman | leaves of grass
Robert Frost | the road not taken
Francis Thompson | the hound of heaven
William Ernest Henley | invictus
Rudyard Kipling | if—; if
Kahlil Gibran | the prophet
Paulo Coelho | the alchemist
Sun Tzu | the art of war
Confucius | the analects
Marcus Aurelius | meditations
Saint Augustine | the confessions; confessions; the city of god
Thomas Aquinas | summa theologica
John Calvin | the institutes of the christian religion
Dietrich Bonhoeffer | the cost of discipleship
Brother Lawrence | the practice of the presence of god
Blaise Pascal | pensées; pensees
"""
IMPLIED_PERSON = {w.strip(): None if p == "(nobody)" else p for p, ws in (line.split(" | ") for line in _IMPLIED.strip().splitlines()) for w in ws.split("; ")}
#: Chunks that are neither titles nor names.
IGNORED = _listed("""
available at gospel library; churchofjesuschrist.org; gospel library; gospel library app; gospel library edition;
gospel topics; ibid; id; in gospel library; lds.org; n.d; n.p; newsroom.churchofjesuschrist.org; see; see also;
topics and background; topics and questions
""")
#: Words inside names that need no capital.
PARTICLES = _listed("""
&; af; al; and; av; bin; da; de; del; della; den; der; des; di; du; el; ibn; ii; iii; iv; jr; jr.; la; le; of; sr; sr.;
ten; ter; van; von; y; zu
""")
#: Leaders of the time before the archive.
HISTORIC_LEADERS = _listed("""
Joseph Smith; Brigham Young; John Taylor; Wilford Woodruff; Lorenzo Snow; Joseph F. Smith; Heber J. Grant;
George Albert Smith; David O. McKay; Hyrum Smith; Oliver Cowdery; Parley P. Pratt; Orson Pratt; Heber C. Kimball;
George Q. Cannon; Orson F. Whitney; James E. Talmage; B. H. Roberts; John A. Widtsoe; J. Reuben Clark Jr.;
J. Reuben Clark; Melvin J. Ballard; Charles W. Penrose; Anthon H. Lund; Francis M. Lyman; Matthew Cowley;
Stephen L Richards; Stephen L. Richards; Hugh B. Brown; Richard L. Evans; Marion G. Romney; N. Eldon Tanner;
Harold B. Lee; Joseph Fielding Smith; Spencer W. Kimball; Ezra Taft Benson; Howard W. Hunter; Gordon B. Hinckley;
Thomas S. Monson; Russell M. Nelson; Eliza R. Snow; Emma Smith; Lucy Mack Smith; Zina D. H. Young; Emmeline B. Wells;
Bathsheba W. Smith; Belle S. Spafford; Amy Brown Lyman; Louise Y. Robison; Clarissa S. Williams; Erastus Snow;
Franklin D. Richards; Moses Thatcher; Rudger Clawson; Reed Smoot; Hyrum M. Smith; George F. Richards; David A. Smith;
Sylvester Q. Cannon; LeGrand Richards; Mark E. Petersen; Delbert L. Stapley; Marion D. Hanks; S. Dilworth Young;
Sterling W. Sill; Bruce R. McConkie; Neal A. Maxwell; Boyd K. Packer; L. Tom Perry; David B. Haight; James E. Faust;
Joseph B. Wirthlin; Richard G. Scott; Robert D. Hales; Jeffrey R. Holland; Henry B. Eyring; Dieter F. Uchtdorf;
Dallin H. Oaks; M. Russell Ballard; George A. Smith; Orson Hyde; Willard Richards; Daniel H. Wells; Jedediah M. Grant;
Amasa Lyman; Joseph Smith Sr.; Samuel H. Smith; William Clayton; Charles C. Rich; Abraham O. Woodruff;
Marriner W. Merrill; John W. Taylor; Matthias F. Cowley; Abraham H. Cannon; Brigham Young Jr.; Anthony W. Ivins;
Richard R. Lyman; Joseph F. Merrill; Charles A. Callis; Alonzo A. Hinckley; Albert E. Bowen; Henry D. Moyle;
Adam S. Bennion; George Q. Morris; Marvin J. Ashton; Louie B. Felt; May Anderson; Aurelia S. Rogers; Ruth May Fox;
Lucy Grant Cannon; Barbara B. Smith; Camilla E. Kimball; Marjorie Pay Hinckley; Elaine L. Jack; Ardeth G. Kapp;
Patricia T. Holland; Chieko N. Okazaki; Sheri L. Dew; Bonnie D. Parkin; Julie B. Beck; Elaine S. Dalton; Linda K. Burton;
Bonnie L. Oscarson; Jean B. Bingham; Joy D. Jones; Camille N. Johnson; Susa Young Gates; Karl G. Maeser; Jesse Knight;
Truman O. Angell; Jacob Hamblin; Porter Rockwell; Edward Partridge; Newel K. Whitney; Sidney Rigdon; Martin Harris;
David Whitmer; Thomas B. Marsh; Lyman Wight; William W. Phelps; W. W. Phelps; John Whitmer; Frederick G. Williams;
Oliver Granger; First Presidency; The First Presidency; Quorum of the Twelve Apostles; The Quorum of the Twelve Apostles;
Council of the Twelve; First Presidency and Quorum of the Twelve Apostles;
The First Presidency and Quorum of the Twelve Apostles; Wendy W. Nelson; Frances J. Monson; Kristen M. Oaks;
Kathleen J. Eyring; Harriet R. Uchtdorf; Donna S. Packer; Flora A. Benson; Ruth W. Faust; Inis S. Hunter;
Colleen H. Maxwell; Susan K. Bednar; Barbara B. Ballard; Kathy J. Christofferson
""")
#: Figures of scripture.
SCRIPTURE_FIGURES = _listed("""
Nephi; Lehi; Jacob; Enos; Mosiah; Benjamin; King Benjamin; Abinadi; Alma; Amulek; Ammon; Helaman; Samuel the Lamanite;
Mormon; Moroni; Captain Moroni; Ether; Jared; Brother of Jared; Adam; Eve; Enoch; Noah; Abraham; Sarah; Isaac; Rebekah;
Joseph; Moses; Aaron; Joshua; Ruth; Samuel; David; Solomon; Elijah; Elisha; Isaiah; Jeremiah; Ezekiel; Daniel; Hosea;
Joel; Amos; Jonah; Micah; Malachi; Job; Esther; Nehemiah; Ezra; Jesus; Jesus Christ; Christ; The Savior; Savior; Mary;
John the Baptist; Peter; James; John; Andrew; Philip; Thomas; Matthew; Mark; Luke; Paul; Stephen; Barnabas; Timothy;
Titus; Jude; Martha; Mary Magdalene; Lazarus; Nicodemus; Zacchaeus; Pilate; Herod; The Lord; Lord; Heavenly Father; God;
The Apostle Paul; Apostle Paul; The Prophet Nephi; The Psalmist; Psalmist
""")
#: The leader whom a lone surname means.
SURNAME_TO_LEADER = _paired("""
nelson | Russell M. Nelson
hinckley | Gordon B. Hinckley
kimball | Spencer W. Kimball
monson | Thomas S. Monson
benson | Ezra Taft Benson
hunter | Howard W. Hunter
mckay | David O. McKay
woodruff | Wilford Woodruff
oaks | Dallin H. Oaks
eyring | Henry B. Eyring
uchtdorf | Dieter F. Uchtdorf
faust | James E. Faust
packer | Boyd K. Packer
tanner | N. Eldon Tanner
romney | Marion G. Romney
ballard | M. Russell Ballard
holland | Jeffrey R. Holland
christofferson | D. Todd Christofferson
bednar | David A. Bednar
andersen | Neil L. Andersen
rasband | Ronald A. Rasband
stevenson | Gary E. Stevenson
renlund | Dale G. Renlund
gong | Gerrit W. Gong
soares | Ulisses Soares
kearon | Patrick Kearon
maxwell | Neal A. Maxwell
mcconkie | Bruce R. McConkie
scott | Richard G. Scott
hales | Robert D. Hales
wirthlin | Joseph B. Wirthlin
perry | L. Tom Perry
haight | David B. Haight
ashton | Marvin J. Ashton
petersen | Mark E. Petersen
talmage | James E. Talmage
widtsoe | John A. Widtsoe
hyde | Orson Hyde
whitney | Orson F. Whitney
penrose | Charles W. Penrose
lund | Anthon H. Lund
ivins | Anthony W. Ivins
callis | Charles A. Callis
bowen | Albert E. Bowen
moyle | Henry D. Moyle
evans | Richard L. Evans
stapley | Delbert L. Stapley
sill | Sterling W. Sill
hanks | Marion D. Hanks
featherstone | Vaughn J. Featherstone
kapp | Ardeth G. Kapp
dew | Sheri L. Dew
beck | Julie B. Beck
okazaki | Chieko N. Okazaki
cowley | Matthias F. Cowley
merrill | Joseph F. Merrill
ballif | Ariel S. Ballif
cook | Quentin L. Cook
causse | Gérald Caussé
caussé | Gérald Caussé
wickman | Lance B. Wickman
clayton | L. Whitney Clayton
hallstrom | Donald L. Hallstrom
zwick | W. Craig Zwick
""")
#: Whom "Sister <surname>" means.
SISTER_TO_NAME = _paired("""
hinckley | Marjorie Pay Hinckley
nelson | Wendy W. Nelson
monson | Frances J. Monson
kimball | Camilla E. Kimball
oaks | Kristen M. Oaks
eyring | Kathleen J. Eyring
holland | Patricia T. Holland
uchtdorf | Harriet R. Uchtdorf
packer | Donna S. Packer
benson | Flora A. Benson
faust | Ruth W. Faust
hunter | Inis S. Hunter
maxwell | Colleen H. Maxwell
bednar | Susan K. Bednar
ballard | Barbara B. Ballard
christofferson | Kathy J. Christofferson
""")
#: First and last names that several people share.
AMBIGUOUS = _listed("""
joseph smith; john smith; john taylor; george smith; hyrum smith; william smith; samuel smith; don smith
""")
#: Surnames that mean the leader only after a title.
UNTITLED_SURNAMES = _listed("""
cook; scott; evans; beck; dew; hyde; sill; hanks; perry; lund; bowen; moyle; clayton
""")
#: Scripture books by their code in links, in canonical order.
BOOKS = _paired("""
gen | Genesis
ex | Exodus
lev | Leviticus
num | Numbers
deut | Deuteronomy
josh | Joshua
judg | Judges
ruth | Ruth
1-sam | 1 Samuel
2-sam | 2 Samuel
1-kgs | 1 Kings
2-kgs | 2 Kings
1-chr | 1 Chronicles
2-chr | 2 Chronicles
ezra | Ezra
neh | Nehemiah
esth | Esther
job | Job
ps | Psalms
prov | Proverbs
eccl | Ecclesiastes
song | Song of Solomon
isa | Isaiah
jer | Jeremiah
lam | Lamentations
ezek | Ezekiel
dan | Daniel
hosea | Hosea
joel | Joel
amos | Amos
obad | Obadiah
jonah | Jonah
micah | Micah
nahum | Nahum
hab | Habakkuk
zeph | Zephaniah
hag | Haggai
zech | Zechariah
mal | Malachi
matt | Matthew
mark | Mark
luke | Luke
john | John
acts | Acts
rom | Romans
1-cor | 1 Corinthians
2-cor | 2 Corinthians
gal | Galatians
eph | Ephesians
philip | Philippians
col | Colossians
1-thes | 1 Thessalonians
2-thes | 2 Thessalonians
1-tim | 1 Timothy
2-tim | 2 Timothy
titus | Titus
philem | Philemon
heb | Hebrews
james | James
1-pet | 1 Peter
2-pet | 2 Peter
1-jn | 1 John
2-jn | 2 John
3-jn | 3 John
jude | Jude
rev | Revelation
1-ne | 1 Nephi
2-ne | 2 Nephi
jacob | Jacob
enos | Enos
jarom | Jarom
omni | Omni
w-of-m | Words of Mormon
mosiah | Mosiah
alma | Alma
hel | Helaman
3-ne | 3 Nephi
4-ne | 4 Nephi
morm | Mormon
ether | Ether
moro | Moroni
introduction | Book of Mormon Introduction
bofm-title | Book of Mormon Title Page
three | Testimony of Three Witnesses
eight | Testimony of Eight Witnesses
js | Testimony of the Prophet Joseph Smith
explanation | Brief Explanation about the Book of Mormon
dc | Doctrine and Covenants
od | Official Declaration
moses | Moses
abr | Abraham
js-m | Joseph Smith—Matthew
js-h | Joseph Smith—History
a-of-f | Articles of Faith
""")
#: Volumes by the code of the first book of each.
VOLUME_STARTS = {"gen": "Old Testament", "matt": "New Testament", "1-ne": "Book of Mormon", "dc": "Doctrine and Covenants", "moses": "Pearl of Great Price"}
#: Studies and helps beside the scriptures, by their code in links.
STUDY_HELPS = {"bd": "Bible Dictionary", "gs": "Guide to the Scriptures", "tg": "Topical Guide", "jst": "Joseph Smith Translation", "harmony": "Harmony of the Gospels", "jst-appendix": "Joseph Smith Translation Appendix"}
#: History titles by their code in links.
HISTORIES = {"saints-v1": "Saints, Volume 1", "saints-v2": "Saints, Volume 2", "saints-v3": "Saints, Volume 3", "saints-v4": "Saints, Volume 4", "topics": "Church History Topics", "joseph-smith-papers": "The Joseph Smith Papers"}

#: What names a publisher after "Place:"; * stands for more letters.
PUBLISHERS = _listed("""
Press; Books?; Publish*; House; Co.; Company; Inc.?; Ltd.?; Sons; University; Office; Center; Centre; Society; Union; Board; Club;
Library; Institute; Foundation; Association; Deseret Book; Bookcraft; Harper*; Random House; Penguin; Macmillan; Scribner*;
Doubleday; Norton; Zondervan; Eerdmans; Collier; Knopf; Viking; Bantam; Dover; Ballantine; Signet; Dell; Putnam*; Dutton; Holt;
Lippincott; Little, Brown; Houghton; Mifflin; Crowell; Revell; Baker; Moody; Nelson; Crossway; Tyndale; InterVarsity; Augsburg;
Fortress; Westminster; Abingdon; Beacon; Basic Books; Free Press; Crown; Hachette; Hyperion; Simon; Schuster; Wiley; McGraw;
Prentice; Pearson; Routledge; Blackwell; Vintage; Anchor; Mentor; Everyman; Bobbs; Grosset; Rinehart; Harcourt; Brace; Collins;
Fontana; Faber; Hodder; Methuen; Longman*; Bles; Hendrickson; Kregel; Bethany; Multnomah; Shadow Mountain; Covenant; Cedar Fort;
Signature; Intellectual Reserve; Religious Studies Center; Church Historian; Juvenile Instructor; Sunday School Union; Shambhala;
Jossey-Bass; Portfolio; Public Affairs; Palgrave; Springer; Elsevier; Academic; Gallimard; Seuil; Mondadori; Planeta; Alfaguara;
Paulist; Orbis; Ignatius; Regnery; Encounter; Modern Library; Loeb; World Publishing; Meridian; Oxford; Cambridge; Yale; Harvard;
Princeton; Chicago; Columbia; Stanford; BYU; Brigham Young University; Religious Tract; Bible Society
""")

# Defaults that callers may extend (Lexicon): common cases only.

TITLE_WORDS = _listed("""
address; addresses; annals; anthology; archives; article; articles; atonement; autobiography; bible; biography; book; books;
chapter; children; christianity; chronicles; church; collected; college; comedy; commandments; commentary; company; complete;
conference; correspondence; covenants; department; devotional; diary; dictionary; discourses; doctrine; doctrines; documents;
encyclopedia; ensign; era; essays; eternal; families; fireside; foundation; god; gospel; guide; handbook; history; hymn; hymns;
ideals; institute; introduction; jesus; christ; journal; journals; kingdom; lectures; lessons; letter; letters; liahona; library;
life; lord; magazine; manual; marriage; masterpieces; meditations; memoirs; mere; messages; minutes; mission; mormonism; national;
news; office; papers; paradise; parables; pioneer; pioneers; poem; poems; poetry; prayer; prayers; preface; press; priesthood;
primary; principles; proceedings; progress; prophets; publishing; questions; quotations; readings; records; relief; reminiscences;
report; restoration; review; sabbath; salvation; saints; sayings; school; screwtape; scriptures; seasons; section; selected;
selections; seminary; sermon; sermons; society; song; songs; sourcebook; spirit; star; statement; states; stories; story; studies;
study; sunday; tale; tales; talk; teachings; temple; temples; testament; testimony; thoughts; times; topics; translation; treasury;
united; university; volume; wisdom; women; words; works; world; writings; youth; the; a; an; in; to; for; on; from; with; by; at;
or; into; upon; unto
""")
MONONYMS = _listed("""
shakespeare; dante; voltaire; plato; aristotle; socrates; confucius; michelangelo; augustine; aquinas; homer; virgil; ovid; cicero;
seneca; epictetus; plutarch; herodotus; sophocles; pythagoras; galileo; newton; darwin; einstein; tolstoy; dostoevsky; chekhov;
goethe; nietzsche; kant; kierkegaard; spinoza; descartes; pascal; montaigne; rousseau; molière; hugo; camus; cervantes; petrarch;
erasmus; luther; calvin; wesley; spurgeon; tennyson; wordsworth; coleridge; keats; shelley; byron; blake; milton; chaucer; donne;
dickens; kipling; yeats; orwell; tolkien; chesterton; bunyan; emerson; thoreau; whitman; dickinson; longfellow; whittier;
hawthorne; melville; poe; twain; frost; hemingway; lincoln; jefferson; franklin; churchill; gandhi; mandela; buddha; rumi; tagore;
maimonides; josephus; origen; chrysostom; eusebius; bonhoeffer; frankl; jung; freud; aesop; horace; tacitus; boethius; kafka;
rilke; borges; neruda; pushkin; solzhenitsyn; nephi; alma; moroni; mormon; helaman; jacob; enos; benjamin; abinadi; ammon; amulek;
lehi; paul; peter; james; john; jude; matthew; mark; luke; isaiah; jeremiah; ezekiel; daniel; moses; abraham; isaac; job; david;
solomon; joshua; samuel; elijah; lewis; teresa
""")
#: Mononyms too common as first names or words to be taken from running text without a verb.
COMMON_FIRST_NAMES = _listed("""
paul; peter; james; john; mark; luke; matthew; david; job; daniel; jacob; joseph; benjamin; samuel; mormon; moroni; nephi; alma; lehi;
enos; helaman; ammon; abinadi; amulek; jude; isaiah; jeremiah; ezekiel; hosea; amos; micah; malachi; moses; abraham; isaac; solomon;
joshua; elijah; elisha; jonah; teresa; lewis; newton; jung; mann; frost; burns; scott; hardy; pope; watts; knox; young; smith;
swift; hugo; gogol; poe
""")
CITIES = _listed("""
Salt Lake City; New York; Provo; Boston; London; Chicago; San Francisco; Grand Rapids; Philadelphia; Princeton; Cambridge; Oxford;
New Haven; Los Angeles; Washington; Nashville; Wheaton; Downers Grove; Minneapolis; Garden City; Englewood Cliffs; Toronto;
Edinburgh; Dublin; Paris; Berlin; Independence; Logan; Ogden; Orem; American Fork; Springville; Bountiful; St. Louis; Kansas City;
Cleveland; Detroit; Atlanta; Dallas; Houston; Denver; Seattle; Portland; Baltimore; Pittsburgh; Cincinnati; Indianapolis;
Milwaukee; Richmond; Hartford; Ithaca; Berkeley; Stanford; Chapel Hill; Ann Arbor; Urbana; Austin; Louisville; Columbus;
Bloomington; Notre Dame; Colorado Springs; Carol Stream; Liverpool; Manchester; Sydney; Melbourne; Mexico City; Tokyo; Geneva; Rome
""")


@dataclass(frozen=True, eq=False)
class Lexicon:
    """The lists that the grammar consults. Pass longer ones to recognise more titles and names."""

    title_words: frozenset[str] = frozenset(TITLE_WORDS)
    mononyms: frozenset[str] = frozenset(MONONYMS)
    common_first_names: frozenset[str] = frozenset(COMMON_FIRST_NAMES)
    periodicals: frozenset[str] = frozenset(PERIODICALS)
    hymnals: frozenset[str] = frozenset(HYMNALS)
    manuals: tuple[str, ...] = MANUALS
    serials: frozenset[str] = frozenset(SERIALS)
    implied: dict[str, str | None] = field(default_factory=lambda: dict(IMPLIED_PERSON))
    ignored: frozenset[str] = frozenset(IGNORED)
    particles: frozenset[str] = frozenset(PARTICLES)
    cities: frozenset[str] = frozenset(CITIES)


def volumes() -> dict[str, str]:
    """Book name -> volume, by canonical order."""
    out, volume = {}, None
    for code, name in BOOKS.items():
        volume = VOLUME_STARTS.get(code, volume)
        out[name] = volume
    return out
