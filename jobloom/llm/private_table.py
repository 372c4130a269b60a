"""The small labelled table the private-data tagger learns from.

``FRAMES`` are sentences labelled by hand: a slot in braces stands where a value
of that kind stood, everything else is no private value; ``PLAIN`` are sentences
without any. ``VALUES`` and ``IDS`` are what stood in the slots, as patterns
(``#`` is a digit, ``^`` a capital letter). All of it was written for this table:
names are common ones of many origins, numbers follow the public formats of
their countries with digits drawn at random.
"""

from __future__ import annotations

KINDS = ("email", "phone", "id_number", "street_address", "person_name")

FRAMES = """
Your recruiter is {person_name} ({email}).
Recruiter - {person_name} - {phone}
{person_name}\\n{phone}\\n{email}
{person_name}, {job}\\n{email}
{person_name}, {job}, {phone}
{person_name} | {job} | {phone} | {email}
{person_name} - {email} - {phone}
{person_name}; {phone}; {email}
Point of contact: {person_name}, {email}
Point of contact: {person_name}, {phone}
People partner: {person_name}; phone {phone}
contact person: {person_name} <{email}>
Hiring lead: {person_name}, {phone}
Recruitment contact {person_name} / {phone}
Interview panel: {person_name}, {person_name} and {person_name}.
Reporting line: {person_name}, {job}.
Manager: {person_name}
Team lead: {person_name}.
Present: {person_name}, {person_name}, {person_name}.
On the panel: {person_name}, {person_name}
{person_name} and {person_name} share the post.
{person_name} or {person_name} will open the door.
written by {person_name}, checked by {person_name}
{person_name} / {phone}
{person_name} / {phone} / {email}
{email}, {person_name}
hosted by {person_name}
Talk to {person_name} before you decide.
{person_name} looks after the books and the visitors.
{person_name} keeps the keys.
{person_name} (people team)
Our lawyer {person_name} reads every contract.
Former head {person_name} stays on as adviser.
From {person_name}'s desk to yours.
Ms {person_name} and Mr {person_name} take turns.
Dr {person_name} heads the lab.
It was {person_name} who drew the plan.
No one but {person_name} has the key.
Posted by {person_name}
Submitted by {person_name} on Monday.
Thanks,\\n{person_name}
Kind regards,\\n{person_name}
Yours sincerely,\\n{person_name}
Many thanks and see you soon\\n{person_name}\\n{job}
Warmly, {person_name}
Feel free to reach out to {person_name} with anything that is unclear.
Please get in touch with {person_name} for a first chat.
On arrival, ask for {person_name} in the lobby.
ask for {person_name} when you arrive
speak to {person_name} about your start date
please contact {person_name} by tuesday
contact {person_name} if anything is unclear
{person_name} leads the interviews and answers within a day.
{person_name} will meet you in the lobby.
{person_name} will be happy to show you around the site.
{person_name} looks forward to your application.
{person_name} will be your guide in the first weeks.
{person_name} will be your mentor.
{person_name} is your contact for all of this.
{person_name} is in charge of the night shift.
{person_name} signs all contracts.
You will work side by side with {person_name}, who built the first version.
The post was held by {person_name}, who is retiring.
This opening replaces {person_name}, who moves to another group.
Direct any questions to {person_name}, our {job}.
The interview is led by {person_name}.
A first call with {person_name} takes half an hour.
Reach {person_name} on {phone} or at {email}.
{person_name} can be reached on {phone}.
Please send your portfolio to {person_name}, {email}.
Attention: {person_name}, {street_address}
c/o {person_name}, {street_address}
E-mail your résumé to {email}
Résumés: {email}
Reach us: {email}
Send a cover letter to {email} by the end of the month.
Please apply by writing to {email}.
Apply via {email} or phone {phone}.
You can email {email} at any time.
drop a line to {email} if interested
({email})
Questions? {email}
Contact us at {email}.
Our inbox is {email}, and we read everything.
email - {email}
My address is {email}.
Phone {phone}
Phone: {phone}
Mobile: {phone}
Cell {phone}, fax {phone}
Ph: {phone} (office hours)
Our number is {phone} during office hours.
Please phone {phone} before noon.
You can reach the desk on {phone} all week.
give us a call on {phone}
text {phone} to book a slot
Text or call: {phone}.
Dial {phone} and ask for the people team.
Hotline {phone}, free of charge.
({phone})
The walk-in day takes place at {street_address}.
Our workshop is at {street_address}.
Come to {street_address} on Thursday.
Bring your papers to {street_address}, second floor.
Mail your documents to {street_address}.
Postal address: {street_address}
Address: {street_address}
The owner lives at {street_address}.
Applicants report to {street_address} at eight.
We moved to {street_address} last autumn.
Parcels go to {street_address}.
the flat is at {street_address}
Swing by {street_address} after work.
Stop by at {street_address} whenever you like.
Pass by {street_address} if you are near.
Visit {street_address} between two and four.
Private home of the manager: {street_address}
Interviews happen near {street_address}.
He gave {street_address} as his home.
On file: {label} {id_number}.
Please keep {label} {id_number} at hand.
Employee record: {label}: {id_number}
Returning colleague with {label} {id_number}.
The applicant's {label} is {id_number}.
Verified, {label} {id_number}
{label}: {id_number}
{label} {id_number}
{label} = {id_number}, checked
A copy shows {label} {id_number} and a photo.
His {label} was given as {id_number}.
Background check passed ({label}: {id_number})
Auskunft gibt {person_name}.
Auskunft erteilt {person_name} gern am Telefon.
Zuständig ist {person_name}.
Es begrüßt Sie {person_name} am Eingang.
Im Sekretariat sitzt {person_name}.
Den Rundgang macht {person_name} mit Ihnen.
Ansprechpartnerin: {person_name}, {phone}
Ansprechpartner für die Bewerbung: {person_name}
Ihr Kontakt: {person_name}, {email}
Personalabteilung: {person_name} ({email})
Kontaktperson: {person_name}
Herr {person_name} führt Sie durch das Haus.
Frau {person_name} kennt die Anlage.
Frau {person_name} und Herr {person_name} teilen sich die Stelle.
Wenden Sie sich gern an {person_name}, Zimmer ##.
Gemeinsam mit {person_name} planen Sie die Woche.
Nach {person_name} übernimmt nun jemand Neues.
Dr. {person_name} leitet das Labor.
Ein Gespräch mit {person_name} steht am Anfang.
{person_name} freut sich auf Ihre Bewerbung.
{person_name} wird Ihre Mentorin.
{person_name} unterschreibt die Verträge.
{person_name} leitet das Bewerbungsgespräch.
{person_name} beantwortet Ihre Fragen.
Viele Grüße\\n{person_name}
Herzliche Grüße aus der Personalabteilung,\\n{person_name}
Fragen beantwortet Ihnen {person_name} unter {phone}.
Bei Fragen hilft {person_name} weiter.
Melden Sie sich bei {person_name} am Empfang.
Ihre Vorgesetzte wird {person_name} sein.
Ihre Ansprechpartnerin ist {person_name}, {job}.
Unterlagen bitte per Mail an {email}.
Ihre Unterlagen senden Sie an {email}.
Richten Sie Ihre Bewerbung an {email} oder rufen Sie {phone} an.
Mail: {email}
Mobil: {phone}
Fon {phone}
Sie erreichen uns telefonisch unter {phone}.
Telefonisch sind wir unter {phone} für Sie da.
Ruf einfach {phone} an
Das Gespräch findet in der {street_address} statt.
Unser Büro liegt in der {street_address}.
Postanschrift: {street_address}
Kommen Sie am Montag in die {street_address}.
Anschrift: {street_address}
Bitte senden Sie alles an {street_address}.
Unsere Werkstatt: {street_address}
Die Filiale {street_address} ist werktags geöffnet.
Wir treffen uns im Laden {street_address} um neun.
Pakete an {street_address}, bitte ohne Nachnahme.
So finden Sie her: {street_address}
Ehemaliger Mitarbeiter mit {label} {id_number}.
Die {label} lautet {id_number}.
Für die Abrechnung: {label} {id_number}
Personalbogen: {label}: {id_number}
(Angabe {label} {id_number})
C'est {person_name} qui vous accueillera.
Le dossier est traité par {person_name}.
Mme {person_name} tient le registre.
M. {person_name} ouvre à huit heures.
Avec {person_name}, vous préparez la semaine.
Un entretien avec {person_name} ouvre la journée.
Sous la conduite de {person_name}, chef d'atelier.
Joindre {person_name} avant midi.
Téléphonez à {person_name} au {phone}.
Contactez {person_name} au {phone}.
Personne à contacter : {person_name}
Personne à contacter : {person_name}, {email}
Votre interlocutrice : {person_name}, {phone}
{person_name} sera votre tuteur.
{person_name} signe les contrats.
{person_name} vous recevra pour un premier échange.
{person_name} répondra à vos questions.
Bien à vous,\\n{person_name}
Bien cordialement\\n{person_name}\\n{phone}
L'entretien sera mené par {person_name}.
Merci de demander {person_name} à l'accueil.
L'équipe est dirigée par {person_name}.
Votre futur responsable est {person_name}.
Pour toute question, adressez-vous à {person_name}.
Envoyez votre dossier à {email}.
Candidatures : {email}
Adresse électronique : {email}
Merci d'envoyer CV et lettre à {email} sous huit jours.
Vous pouvez nous écrire à {email} à tout moment.
Joignable au {phone} en semaine.
Composez le {phone} aux heures de bureau.
Portable : {phone}
Vous pouvez nous joindre au {phone}.
Nos bureaux se trouvent au {street_address}.
Adresse : {street_address}
Rendez-vous au {street_address} lundi.
Envoyez votre courrier au {street_address}.
Siège : {street_address}
On se retrouve devant le {street_address}.
Les essais auront lieu {street_address}.
Dossier du salarié : {label} {id_number}.
Son {label} est le {id_number}.
Indiquer {label} {id_number} sur la fiche.
({label} : {id_number})
Te atenderá {person_name} en la puerta.
De las visitas se ocupa {person_name}.
La señora {person_name} lleva el registro.
Don {person_name} abre a las ocho.
Con {person_name} prepararás la semana.
Una charla con {person_name} abre el día.
Preguntar por {person_name} en la tienda.
Pide cita con {person_name} o escribe.
A las órdenes de {person_name}, jefe de taller.
Avisa a {person_name} antes de venir.
Persona de contacto: {person_name}
Persona de contacto: {person_name}, {email}
Contacto: {person_name} ({phone})
{person_name} será tu tutora.
{person_name} firma los contratos.
{person_name} te recibirá el primer día.
{person_name} resolverá tus dudas.
Saludos cordiales,\\n{person_name}
Atentamente,\\n{person_name}\\n{email}
La entrevista la hará {person_name}.
Al llegar, pide hablar con {person_name}.
El equipo lo dirige {person_name}.
Tu jefa será {person_name}.
Para cualquier duda, habla con {person_name}.
Envía tu currículum a {email}.
Candidaturas: {email}
Puedes escribirnos a {email} cuando quieras.
Correo electrónico: {email}
Llámanos al {phone} en horario de oficina.
Móvil: {phone}
Tfno. {phone}
Puedes llamar al {phone} por la tarde.
La oficina está en {street_address}.
Domicilio: {street_address}
Las pruebas serán en {street_address}.
Nos vemos delante de {street_address}.
Ven el lunes a {street_address}.
Manda los papeles a {street_address}.
Dirección postal: {street_address}
Ficha del empleado: {label} {id_number}.
Su {label} es {id_number}.
Consta {label} {id_number} en el archivo.
({label}: {id_number})
""".strip().splitlines()

# Sentences without private values, many of which look as if they had some.
PLAIN = """
Reference number ##-###-#### must be stated in every reply.
Your order ###-##-#### left the warehouse this morning.
Job reference ###-##-####, closing soon.
Vacancy ID ^######## is still open.
Case ^######## was closed without a finding.
Booking no. ^####### is confirmed.
Order no. ######## was delivered in two parts.
The contract number is ##########.
Serial number ###-####-#### is out of warranty.
Tracking code ### ### ### ### belongs to the blue crate.
Bill #### #### was settled in May.
We paid bill #### ### ## late.
Pay scale ##-###-#### is under review.
Grade ## ### #### of the pay table was dropped.
Part ###.##.### fits every model since ####.
Release ##.##.# fixes the import, release ##.##.## the export.
Paragraph ##.## of rule #### was changed.
The plant has ## furnaces, a #### t crane and # docks.
The pool is ## m long, the hall ### m wide.
We ran ##,### tests on ##/##/##, most of them at night.
Desk ##, level #, locker ###, gate ##.
Building #, room ###.
Open from #:## to ##:## on all ### days of the year.
The {surname} Award for {thing} was given to our {team} group.
The {first name} {surname} Medal went to a team of ##.
The {surname} Foundation and {org} share the costs.
Our product {surname} Suite ## replaced the old {team} tool.
The {first name} {street} bridge project was finished in ####.
Trains stop at {surname} Park and at {street} Station.
Follow @{org_low}## to hear from us.
We are @{org_low}jobs on every network.
Write at least ten lines, at most a page.
Look us up at our site dot com, under careers.
Post it in the forum at {org_low} dot business.
Ask in the group chat at {org_low} dot internal.
Take the {team} thread at corp dot network for that.
{thing}, an {number}-day autumn pause and {thing} come on top.
We offer an {number}-week onboarding and a {number}-day week.
Find the form at acme dot org, or ask at reception.
Everything is posted on the board at brightco dot net.
You will find the team at lunch, at the window.
Meet the {team} group at the spring fair, hall ##.
contact support before you buy a ticket
contact sales if anything is unclear
ask for details at any time
call for papers, deadline in june
please contact the {team} desk by tuesday
speak to the {team} desk about your start date
Feel free to reach out to our {team} desk with anything that is unclear.
Please get in touch with the {team} desk for a first chat.
Kind regards,\\nyour {team} team
Thanks,\\nThe {org} Team
{org} leads the market and answers its clients within a day.
{org} will open a second site in {city}.
{org} will be happy to see you in {city}.
{org} looks for people who care.
{org} was started by two sisters in a garage in {city}.
{org} is hiring a {role} in {city}.
{org} has grown to ### people in {city} and {city}.
{org} seeks a {role} (m/f/d).
{org} is a {adjective} maker of tools for the {team} trade.
{org} was founded in #### by a chemist.
{org} was founded after a long strike.
Every {role} at {org} spends an hour a day on reading.
{org} is looking for new faces.
{org} is looking for a {adjective} {role} to share the load.
{org} is a place where people stay.
As the next {role} you decide what is built.
We need you as a {role} in {city} or {city}.
The post can be filled from {city} or {city}, or fully from afar.
How do you run a {adjective} plan without a budget?
Who wants to build a {adjective} stack without shortcuts?
In {city} the team is small.
Work as {role} means lists, calls and patience.
{org} sucht Leute für den Standort {city}.
{org} sucht für die Werkstatt eine ruhige Hand als {role}.
Wir suchen jemanden als {role}. Fangen Sie bald an.
{org} busca gente con oficio.
{org} busca una mano firme como {role} en {city}.
{org} recherche des gens de métier.
{org} recherche une aide pour la saison.
{org} recherche une main sûre comme {role} à {city}.
We run ###,#### machines, ##/#/## of them day and night.
{org} was set up in #### by ## people.
{org} and its ## shops are growing.
{org} has no dress code.
Each {role} at {org} gets {thing}.
As a {role} at {org} you decide a lot.
You bring patience, some {tool} and a {adjective} mind.
It takes {adjective} hands, {tool} and time.
To do this well you need care, {tool} and good shoes.
You bring {adjective} {tool}, basic {tool} and curiosity.
What helps: {adjective} {tool}, a little {tool}, and humour.
Who you are: {adjective}, honest, quick.
A {adjective} {role}, two {role} posts and a new {team} plan are on the way.
Two engineers, one buyer and you form a {adjective} group.
The founders, the {job} and clients in ## towns rely on this plan.
Once a year the {team} group measures its {adjective} work and shows it to everyone.
If the night shift fails, a rota of ## people steps in.
{tool} and {tool} are helpful, but not required.
We went from {tool} to {tool} within a summer and would do it again.
After years of {tool} the plant changed to {tool} overnight.
We left {tool} for {tool} early on.
{org} is looking for a second shift.
{org} is looking at its numbers twice a day.
You work from {city} or from the road.
The desk can be run from {city} as well.
{org}, based in {city}, builds tools for the {team} trade.
At {org}, every {role} talks to clients.
Join {org} as a {role}.
Life at {org} is calm.
About {org}: we make {thing} simple.
Why {org}? Because of {thing}.
You will work side by side with {org}, who built the first version.
Direct any questions to {org}, our partner.
The service is led by {org}.
Our partners are {org}, {org} and {org}.
A first call takes half an hour, the second one a little more.
The {role} reports to the {job}.
A {role} works with the {job} and the {team} group.
The {job} decides, the {role} prepares.
Reporting line: {job}.
Manager: to be named
Location: {city}
Location: {city} or {city}, hybrid.
Department: {team}
Position: {role}
Salary: ##,### to ##,### a year, plus bonus.
Compensation: ###,### – ###,### depending on grade.
We pay between ##,### and ###,### and offer {thing}.
{thing}, {thing} and more are on offer.
You know {tool} and {tool}, or you learn fast.
{tool}, {tool} or {tool} would be a plus.
Our stack: {tool}, {tool}, {tool}.
Some {tool} is needed, much {tool} is welcome.
You have # to ## years of practice in a similar role.
We are ## people from ## countries and speak English at work.
About ### shops use what we make, and ## join each month.
The job starts in May and lasts ## months at least.
Half of the week is spent in {city}, the rest wherever you like.
Our building in {city} has a garden, bikes and a view of the harbour.
From {city} you reach us by train in ## minutes.
In {city} and {city} we run small labs.
You plan, write and test changes to the {team} system together with colleagues from {city}.
Nobody here works alone; each change is read by a second person.
Most questions are settled in writing, and meetings end on time.
Each week you look after the {team} queue for a day.
What matters to us is that you ask before you guess.
Why is this post open? Because the {team} work has doubled since spring.
How do you handle a release that goes wrong on a Friday?
Tell us about the last thing you took apart and put together again.
Equal chances matter: we judge work, not names or papers.
We do not take profiles from agencies.
Your data is stored for ### days and then deleted.
Because the audits are due in autumn, the start date can't move.
The {team} desk, the {team} desk and the {job} share one plan.
When a client calls, the {team} group picks up first.
It is a full-time post with ## hours a week, remote work is possible on ## days.
You get ## days off, a laptop and time to read.
Travel: about ## %.
Good to know: the lift is slow.
Here is what you will do:
What we offer
Your profile
Who we are
Senior {role} wanted in {city}.
Für unser Team in {city} suchen wir ab sofort eine {role}-Kraft.
{org} ist ein Familienbetrieb aus {city} mit ### Beschäftigten.
{org} entwickelt seit #### Maschinen für die Landwirtschaft.
{org} sucht Verstärkung im Bereich Einkauf.
{org} sucht eine zuverlässige Kraft für den Standort {city}.
Kenntnisse in {tool} oder {tool} sind nützlich, aber kein Muss.
Praxis mit {tool} ist hilfreich, jedoch keine Voraussetzung.
Ein Führerschein ist von Nutzen, jedoch kein Muss.
Was von Bedeutung ist, steht im Plan von {city}.
Von Anfang an arbeiten Sie mit {tool} und {tool}.
Übung in {tool} und {tool} wäre von Wert, bleibt aber freiwillig.
Der Bereich Technik ist klein, die Stimmung freundlich.
Sie prüfen Verträge, beraten Kollegen und verbessern Abläufe im Bereich Finanzen.
Im Team Buchhaltung sind derzeit ## Stellen besetzt.
Der Besuch in der Filiale dauert ## Minuten.
Werden Sie Teil von {org} in {city}.
Bei {org} zählt das Ergebnis, nicht die Uhr.
Das Gehalt liegt zwischen ##.### und ##.### Euro im Jahr.
Sie erhalten ## Tage Urlaub, ein Jobticket und Zuschüsse zur Kinderbetreuung.
Zwei Tage pro Woche arbeiten Sie im Büro, den Rest zu Hause.
Ihre Aufgaben: Prüfung der Rechnungen, Pflege der Stammdaten, Betreuung der Kunden.
Sie bringen eine abgeschlossene Ausbildung und Freude am Umgang mit Menschen mit.
Gute Kenntnisse in {tool} setzen wir voraus, {tool} können Sie bei uns lernen.
Die Abteilung Vertrieb besteht aus ## Mitarbeitenden in ## Ländern.
Wir freuen uns auf Menschen, die mitdenken und Verantwortung tragen.
Nach einer Probezeit von # Monaten wird der Vertrag verlängert.
Auftrag ######### wurde gestern ausgeliefert.
Die Kennziffer ###-##-#### bitte immer angeben.
Stellennummer ^########, bitte nennen.
Rechnung Nr. #### ### ist bezahlt.
Halle #, Tor ##, Ebene #.
Der Preis der Stadt {city} ging an unsere Lehrlinge.
Die Abteilung Einkauf hilft gerne weiter.
Das Team Logistik prüft den Bestand, das Team Technik die Anlagen.
Melden Sie sich bei der Abteilung Personal am Empfang.
Bei Fragen hilft unser Serviceteam weiter.
Viele Grüße\\nIhr Team Personal
Gemeinsam mit der Leitung Technik planen Sie den Umbau der Datenhaltung.
Was Sie erwartet: kurze Wege, offene Türen und eine gute Kantine.
Mit E-Bike, Kita-Platz und Job-Ticket kommen Sie gut an.
Die IT-Abteilung und das Back-Office teilen sich ein Stockwerk.
Voll-ID ###, Los-Nr. ####, Charge ##-###.
Die Einarbeitung dauert ## Wochen und endet mit einem Gespräch.
Kundinnen und Kunden schätzen unsere Sorgfalt seit ## Jahren.
Für das Berichtswesen nutzen wir {tool}, für die Planung {tool}.
Schichtarbeit ist nicht vorgesehen, Rufbereitschaft an ## Tagen im Jahr.
Nous recrutons à {city} pour notre site de production.
{org} est une entreprise familiale installée à {city} depuis ####.
{org} conçoit des outils pour les artisans.
{org} cherche un renfort pour son service achats.
{org} recherche un profil sérieux pour son site de {city}.
Connaître {tool} et {tool} est utile, sans plus.
Un casque est de rigueur, un sourire aussi.
Les journées commencent à # heures et finissent avant ## heures.
Il faudra suivre les stocks, puis former les équipes.
Rejoignez {org} à {city}.
Chez {org}, chacun a son mot à dire.
Le salaire se situe entre ##.### et ##.### euros par an.
Vous aurez ## jours de congés, des tickets repas et une mutuelle.
Deux jours par semaine se font au bureau, le reste chez vous.
Vos missions : contrôler les factures, suivre les commandes, aider les clients.
Vous maîtrisez {tool} et vous avez envie d'apprendre {tool}.
Le service compte ## personnes réparties dans ## pays.
La période d'essai dure # mois, renouvelable une fois.
La commande ######### est partie hier.
Référence ###-##-#### à rappeler dans votre réponse.
Offre n° ^########, à mentionner.
La facture ## ## ## ## est réglée.
Bâtiment #, porte ##, étage #.
Le prix de la ville de {city} a été remis à nos apprentis.
Le service achats répondra à vos questions.
Merci de demander le service achats à l'accueil.
Bien à vous,\\nL'équipe {org}
Il s'agit de suivre la chaîne logistique et de former les nouveaux.
Ce que nous aimons : des idées simples et des comptes clairs.
Une bonne pratique de {tool} serait un plus.
Notre usine tourne ## heures par semaine, jamais le dimanche.
Dans le cadre du projet, vous préparez les bilans avec le contrôle de gestion.
Buscamos gente para nuestro almacén de {city}.
{org} es una empresa familiar de {city} con ### empleados.
{org} fabrica piezas para el campo desde ####.
{org} necesita refuerzos en el área de compras.
{org} busca personal serio para su planta de {city}.
Saber {tool} y {tool} ayuda, pero no hace falta.
Un casco es de ley, una sonrisa también.
La jornada empieza a las # y acaba antes de las ##.
Hay que cuidar el inventario y después formar a los equipos.
Únete a {org} en {city}.
En {org} todo se habla.
El salario está entre ##.### y ##.### euros al año.
Tendrás ## días de vacaciones, comedor y ayuda para el transporte.
Dos días por semana se trabaja en la oficina, el resto en casa.
Tus tareas: revisar facturas, cuidar los datos, atender a los clientes.
Sabes {tool} y quieres aprender {tool}.
El departamento tiene ## personas en ## países.
El periodo de prueba dura # meses.
El pedido ######### salió ayer.
Indica la referencia ###-##-#### en tu respuesta.
Oferta ^########, no la olvides.
La factura ### ### ### está pagada.
Nave #, puerta ##, planta #.
El premio de la ciudad de {city} fue para nuestros aprendices.
El departamento de compras resolverá tus dudas.
Al llegar, pide hablar con el departamento de compras.
Saludos cordiales,\\nel equipo de {org}
Se trata de vigilar el almacén y de formar a los nuevos.
Lo que nos gusta: cuentas claras y reuniones cortas.
Se agradece algo de {tool} y bastante {tool}.
La fábrica abre ## horas por semana y cierra en agosto.
Junto con el área de finanzas prepararás los informes del mes.
""".strip().splitlines()

# Things that are no private values, wherever they stand.
THINGS = """
at {org}
bei {org}
chez {org}
en {org}
with {org}
{org}
room ###, level ##, key ####
Room ###, wing #, key ####
suite of ## rooms
order no. ########
Order ^########
ticket ^########
Ticket #########
job code ###-##-####
Vacancy ##-###-####
invoice #### ### #
bill ##### ##
version ##.#.##
section ##.# of form ####
###,#### users
##/##/##
##.##.####
##:## to ##:##
## kg, ### m and ## km
{number}-day {thing}
{number}-week autumn pause
{number}-hour shift
{city} and {city}
{role} or {role}
{tool}, {tool} and {tool}
{adjective} {tool}
{role}
{role} and {role}
from {city} or {city}
as {role}
the forum at {org_low} dot business
the list at {org_low} dot internal
the {surname} Prize
the {org} Cup ####
""".strip().splitlines()

VALUES = {
    "number": "two | three | four | five | six | seven | eight | nine | ten | twelve | thirty",
    "phone": """
+1 2## 3## #### | +1 (4##) 2##-#### | (6##) 4##-#### | 7##-2##-#### | 8##.6##.#### | 9## 3## #### | 1-8##-2##-#### | 1 (2##) 8##-#### | +12########## | (8##)3##-#### | 3##-4##-#### ext. ### | (5##) 6##-#### x## | +1-9##-3##-#### | 2##.8##.#### ext ##
+44 161 4## #### | 0161 4## #### | +44 7### ###### | 07### ###### | (0117) 9## #### | 0044 117 9## #### | +44 (0)131 2## #### | +44731####### | 01865 ###### | 020 3### #### | (020) 8### #### | +44 20 3### #### | 0044 20 8### ####
+49 89 ###### | +49 (0)221 ###-## | 0221 / ####-### | 089/####### | (0711) ### ### | 0171 ####### | +4917######## | 0049 711 ###### | +49-351-######| 0351 ### ##-## | 040 ######## | (069) #### ### | 0201 #######
+33 4 7# ## ## ## | 04 7# ## ## ## | 06.1#.##.##.## | +336######## | 0033 6 ## ## ## ## | +33 (0)1 4# ## ## ## | 02-4#-##-##-## | 07########
+34 93# ### ### | 93# ### ### | +34 6## ## ## ## | 6## ### ### | 0034 95# ### ### | (+34) 6######## | +3495####### | 91# ## ## ## | (+34) 96# ### ###
+39 02 ### #### | +31 20 ### #### | +41 44 ### ## ## | +43 1 ### ####| +46 8 ### ### ## | +48 22 ### ## ## | +91 98### ##### | +81 3-####-#### | +55 11 9####-#### | +353 1 ### ####
""",
    "house end": "Street | Street | St | St. | Road | Road | Rd | Rd. | Avenue | Ave | Ave. | Lane | Ln | Drive | Dr | Dr. | Court | Ct | Boulevard | Blvd | Way | Terrace | Place | Pl | Square | Close | Crescent | Hill | Row | Walk | Gardens | Grove | Mews | Parkway | Circle | Rise | Green | Highway",
    "unit": ", Suite ### | Suite ## | , Apt ## | Apt #^ | , Unit # | Unit ##^ | , Flat # | , Floor # | #### | , Apt. ### |  |  |  |  |  |  |  |  |  | ",
    "street": "Maple | Cedar | Hawthorn | Elm Tree | Station | Church | Victoria | Park | Orchard | Chestnut | Mulberry | Bay | Lakeview | Sycamore | Northgate | Old Town | Queen Anne | Bishop | Sunset | Prospect | River Bend | Birch | Fairview | Highfield | Kings | Mayflower | Spruce Hollow | Washington | Franklin | Meadow | Pine Crest | Garfield | Walnut Tree | Long Acre | Harbour View | West 42nd | 5th | 23rd | Martin Luther King | St. James | Upper Bridge | Little Orchard",
    "strasse": "Haupt | Bahnhof | Garten | Schiller | Goethe | Kirch | Ring | Linden | Wiesen | Berg | Schul | Mozart | Birken | Rosen | Wald | Markt | Kaiser | Brücken | Dorf | Tal | Kasernen | Sonnen | Fichten | Nord | Post | Kanal | Wilhelm | Luisen | Beethoven | Friedrich | Ahorn",
    "strasse end": "straße | straße | str. | strasse | weg | platz | allee | gasse | ring | ufer | damm | steig | hof | -Straße | -Allee | -Weg | -Platz",
    "german street": "Am Markt | Am Stadtpark | An der Kirche | Unter den Eichen | Auf dem Berg | Im Winkel | Zum Hafen | Berliner Straße | Kölner Allee | Münchner Str. | Neue Gasse | Breite Straße | Karl-Marx-Allee | Otto-Hahn-Straße | Am Alten Rathaus | Hinter der Mauer | Lange Reihe",
    "french way": "rue | rue | rue | avenue | boulevard | place | allée | chemin | impasse | quai | cours | passage | square | route | Rue | Avenue",
    "french name": "de la République | Victor Hugo | des Lilas | du Moulin | de la Gare | Pasteur | des Écoles | Jean Jaurès | de l'Église | du Général Leclerc | Saint-Michel | des Acacias | de Bretagne | du Port | Voltaire | des Peupliers | de la Fontaine | Molière | du Marché | d'Alsace | des Trois Frères | de Verdun | Émile Zola",
    "spanish way": "Calle | Calle | Calle | C/ | Avenida | Avda. | Paseo | Plaza | Camino | Ronda | Travesía | Carrera | Rambla | calle | Av.",
    "spanish name": "Mayor | de Alcalá | del Sol | de la Constitución | San Juan | de Goya | Real | de la Iglesia | de los Reyes | Serrano | del Río | de Cervantes | Nueva | de la Libertad | Santa Ana | de Velázquez | de las Flores | Colón | del Carmen | de Aragón | de Murcia",
    "email domain": "northlake.test | firma-mail.de | kanzlei.invalid | atelier.fr | correo.es | jobs.brightharbor.com | studio9.io | people-desk.org | hr.uniworks.net | fabrik.eu | talent.co.uk | oficina.com | bureau.org | werk.ch | gmail.test | team.acme.io | outlook.invalid | web.invalid",
    "first name": """
Adam Agnes Ahmed Aisha Albert Alejandro Alice Amara Amelia Amir Ana Anders Andrea Andrew Angela Anita Anna Antoine Antonio Astrid Barbara Benjamin Bernd Bianca Birgit Brian Camille Carlos Carmen Caroline Catherine Charles
Charlotte Chen Christian Claire Clara Claudia Colin Daniel David Deborah Deepak Denise Dimitri Dominik Dorothea Edward Elena Elisabeth Émilie Emma Enrique Erik Esther Eva Fatima Felix Fernando Florian Francesca Francisco
Frank François Gabriel Georg George Gerhard Giulia Gloria Grace Günther Hannah Harold Hassan Heather Heike Helen Hélène Hiroshi Hugo Ibrahim Irene Isabel Ivan Jack Jacqueline James Jan Javier Jennifer Jessica Joanna
João Johannes John José Joseph Juan Judith Julia Julien Jürgen Karen Karim Katarzyna Katrin Keiko Kenneth Kevin Laila Laura Lena Leon Li Liam Linda Louis Luca Luis Luise Magdalena Manuel Marcus Margaret María Marie
Mark Markus Martin Mary Mathieu Matthias Mehmet Mei Michael Miguel Mohammed Monika Natalia Nathalie Nicolas Nina Olga Oliver Olivia Oscar Pablo Patricia Paul Pedro Peter Philippe Pilar Rachel Rafael Raj Raquel Rebecca
Richard Robert Rosa Ruth Samuel Sandra Sarah Sebastian Sergio Sofia Stefan Stephen Susan Svetlana Sven Sylvie Takeshi Tanja Teresa Thomas Timothy Ursula Valérie Vanessa Victor Viktor Wei William Wolfgang Yasmin Yuki Zoë
""",
    "surname": """
Abbott Acosta Adeyemi Ahmed Almeida Andersson Armstrong Bailey Banerjee Barbieri Bauer Becker Bennett Bergström Bernard Bianchi Blanc Boateng Braun Campbell Carvalho Castillo Chaudhary Chen Clarke Cohen Colombo
Cooper Cruz Dahl Das Delgado Deschamps Diallo Dubois Dupont Edwards Eriksen Esposito Evans Fernández Ferrari Fischer Fontaine Foster Fournier Friedmann Fujita García Gauthier Gómez Graf Gupta Haddad Hansen Harris
Hartmann Herrera Hoffmann Horváth Huang Hughes Ito Ivanov Jackson Jansen Jensen Jiménez Johnson Kaminski Kapoor Kaufmann Keller Khan Kim Klein Kowalczyk Krüger Kumar Lambert Lange Larsen Laurent Lee Lefèvre Lehmann
Lindqvist Lombardi López MacLeod Marchetti Martín Martínez Mbeki Mercier Meyer Mitchell Molina Moreau Moreno Morgan Müller Murphy Nakamura Navarro Nguyen Nielsen Novak O'Brien O'Connell Okafor Olsen Ortiz Osei Owusu
Papadopoulos Park Patel Peeters Pereira Petersen Petrov Popescu Ramírez Ramos Reyes Richter Rivera Roberts Robinson Romano Rossi Rousseau Roux Ruiz Saito Santos Sato Schäfer Schmitt Schneider Schröder Schulz Scott
Sharma Silva Simon Singh Smirnov Sørensen Stewart Suzuki Taylor Thompson Torres Turner Vargas Vogel Wagner Walker Wang Watanabe Weber Weiss Whitaker Winter Wójcik Wright Yamamoto Yılmaz Zhang Ziegler
""",
    "thing": "a bike to lease | private health cover | a travel card | a gym pass | stock options | free lunch | paid volunteer days | sabbaticals | a training budget | child care | a company pension | a laptop of your choice",
    "tool": "Ruby | Scala | Spark | Docker | Git | Linux | SAP | Oracle | Jira | AutoCAD | Photoshop | Salesforce | Rust | Kotlin | MATLAB | Ansible | Word | SPSS | GraphQL | Swift | C++ | C# | .NET | Node.js | PL/SQL | R | Power BI | Notepad++ | CI/CD | Objective-C",
    "team": "sales | finance | security | payments | support | design | quality | procurement | logistics | research | legal | marketing | reporting | mobile | network",
    "city": "Toronto | Zürich | Exeter | Vienna | Antwerp | Genoa | Köln | Grenoble | Valencia | Oslo | Porto | Sydney | Mexico City | Saint Paul | Baton Rouge | Graz | Swansea | Las Palmas | Le Havre | Bad Homburg | Santa Fe",
    "role": "Nurse | Plumber | Backend Developer | Project Assistant | Senior Buyer | Warehouse Lead | Payroll Clerk | Physics Teacher | Truck Driver | Quality Inspector | Chief Engineer | Junior Chemist | Night Auditor | Store Manager | Technical Writer | Network Planner",
    "job": "Head of People | HR Business Partner | Talent Manager | Office Lead | Managing Director | Recruiting Partner | Head of Engineering | Plant Manager | Personalreferentin | Directrice des ressources humaines | Jefe de personal | Chief of Staff | Recruiter | Geschäftsführer",
    "adjective": "steady | solid | quiet | small | curious | friendly | careful | well-run | hands-on | modern | modest | patient",
    "org end": "Inc. | LLC | GmbH | Group | Labs | Systems | Partners | Logistics | Media | Foods | & Sons | Ltd | Bank | Clinics | Solutions | Works | AG | SARL | S.L. |  |  |  |  |  |  | ",
}

IDS = {
    "social security no. | social security number | SSN | SSN: | SSN# | SS number | soc. sec. no.": "###-##-#### | ### ## #### | #########",
    "passport number | passport no. | passport no | passport # | Passport": "######### | ^######## | ^^####### | ^#^#^###",
    "driver's license | driver's license no. | driving licence | driver license # | driving licence number | driver licence no. | driver licence": "^###-####-#### | ^######## | ^####-#####-##### | ^^###### | ######### | ^#########",
    "national insurance number | NI number | NI no. | NINO | National Insurance": "^^ ## ## ## ^ | ^^######^ | ^^ ######^",
    "taxpayer ID | ITIN | tax ID | TIN | taxpayer number | tax number": "9##-##-#### | 9######## | ##-####### | ###-##-####",
    "residence permit no. | national ID | identity card no. | ID card | identity card number": "######### | ^^#^##^#^ | ^######## | ^^#######",
    "Steuernummer | Steuer-Identifikationsnummer | Steueridentifikationsnummer | Steuer-ID | Identifikationsnummer | Steuer-IdNr. | steuerliche ID": "## ### ### ### | ########### | ##/###/##### | ### / #### / ####",
    "Sozialversicherungsnummer | SV-Nummer | Rentenversicherungsnummer | RV-Nr.": "## ###### ^ ### | ########^### | #### ######",
    "Reisepass-Nr. | Passnummer | Ausweisnummer | Personalausweis Nr. | Führerschein-Nr.": "^########| ^##^##^## | ^#^^#^#^# | ^^##^^##^ | ######### | ^^^######",
    "n° de sécurité sociale | numéro de sécu | n° de sécu. | NIR | numéro de sécurité sociale | numéro INSEE": "1 ## ## ## ### ### ## | 2 ## ## ## ### ### | 1############## | 2 ## ## ## ### ### ##",
    "numéro fiscal | carte d'identité n° | passeport n° | numéro de passeport | permis de conduire n°": "## ## ### ### ### | ############ | ##^^##### | #############",
    "documento de identidad | DNI n.º | DNI: | núm. de DNI | NIE n.º | NIE: | NIF | DNI | NIE | permiso de residencia": "########^ | ########-^ | ^#######^ | ^#######-^ | ##.###.###-^ | ^-#######-^",
    "número de la Seguridad Social | pasaporte n.º | pasaporte | número de afiliación | carné de conducir": "##/########/## | ^^^###### | ## ######## ## | ########^",
}
